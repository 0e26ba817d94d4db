"""Operator 7, token counts: overlap resynchronisation.

A huge document is encoded in overlapping chunks.  Where two neighbouring
chunks agree on a token boundary that is provably independent of what lies
beyond the chunks, they are spliced: the left chunk's tokens up to it, the
right chunk's from it.  If the overlap holds no such boundary it is widened,
at last to the whole rest of the document, so the count always equals that of
the whole text.

Why a boundary is proven: the tokenizer's pre-tokens are runs of letters, of
digits or of other visible characters, with at most one space before them, or
white space.  No pre-token holds a visible character followed by white space,
nor an ASCII letter followed by a digit, nor an ASCII digit followed by a
letter, nor an ASCII letter or digit followed by ASCII punctuation.  Such a
place ends a pre-token whatever stands to its right, and matching restarts
there whatever stands to its left.  Added special strings are searched for
before; a place at least their length away from the chunks' ends lies inside
one in both chunks or in neither, and inside one no token boundary is seen.
"""

from __future__ import annotations

import os
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import importable, worker_store

CHUNK = 32_768     #: characters of a chunk
OVERLAP = 256      #: characters that neighbouring chunks share at first
BATCH = 1 << 20    #: characters that are encoded in one call


def load(path: str):
    """The tokenizer of a ``.json`` file, loaded once per Python worker."""
    store = worker_store("tokencount")
    if path not in store:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        store[path] = tok
    return store[path]


def proven(text: str, p: int) -> bool:
    """Is there a pre-token boundary at ``p`` whatever surrounds the text?"""
    a, b = text[p - 1], text[p]
    if b in " \n\t\r":
        return a not in " \n\t\r" and (a.isalnum() or "!" <= a <= "~")
    if not (a.isascii() and a.isalnum() and b.isascii()):
        return False
    if a.isalpha():
        return b.isdigit() or (not b.isalnum() and "!" <= b <= "~")
    return b.isalpha() or (not b.isalnum() and "!" <= b <= "~")


def splice(text: str, encode, margin: int, chunk: int = CHUNK, overlap: int = OVERLAP):
    """Token ids of ``text``, by chunks.  ``encode(str)`` gives ids and
    character offsets; ``margin``: length of the longest special string."""
    ids: list[int] = []
    start, skip = 0, 0            # start of the left chunk; its first tokens that are already out
    end = min(len(text), chunk)
    left_ids, left_off = encode(text[start:end])
    while end < len(text):
        wide = max(overlap, 2 * margin + 2)
        while True:
            nxt = max(start, end - wide)
            if nxt <= start:      # nothing shared is left to try: the left chunk grows instead
                end = min(len(text), end + max(chunk, end - start))
                keep = left_off[skip][0] if skip < len(left_off) else end - start
                left_ids, left_off = encode(text[start:end])
                skip = next((k for k, o in enumerate(left_off) if o[0] >= keep), len(left_off)) if keep else 0
                break
            stop = min(len(text), nxt + max(chunk, 2 * wide))
            right_ids, right_off = encode(text[nxt:stop])
            lefts = {o[0] + start: k for k, o in enumerate(left_off) if o[0] + start >= nxt}
            cut = None
            for k, o in enumerate(right_off):
                p = o[0] + nxt
                if p + margin > end:
                    break
                if p - margin >= nxt and p in lefts and lefts[p] >= skip and k and right_off[k - 1][1] + nxt <= p and proven(text, p):
                    cut = (lefts[p], k)
                    break
            if cut:
                ids.extend(left_ids[skip:cut[0]])
                start, end, left_ids, left_off, skip = nxt, stop, right_ids, right_off, cut[1]
                break
            wide *= 2
    ids.extend(left_ids[skip:])
    return ids


def special_margin(tok) -> int:
    return max([1, *(len(t.content) for t in tok.get_added_tokens_decoder().values())])


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, chunk: int = CHUNK,
                 overlap: int = OVERLAP, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Count the tokens of every whole text, as the tokenizer at ``path`` (a
    tokenizers file with byte-level pre-tokens) gives them.

    Returns key, n_bytes (UTF-8), n_tokens, over_limit.  Null text counts as
    empty; repeated rows are counted alike; other columns are not read.  A
    task holds one batch of rows and the chunks of one document at a time.
    """
    def run(batches):
        import pyarrow as pa
        tok = load(path)
        margin = special_margin(tok)

        def encode(s):
            e = tok.encode(s, add_special_tokens=False)
            return e.ids, e.offsets

        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            counts = [0] * len(texts)
            todo, size = [], 0

            def flush():
                for k, e in zip(todo, tok.encode_batch_fast([texts[k] for k in todo], add_special_tokens=False)):
                    counts[k] = len(e)

            for k, t in enumerate(texts):
                if len(t) > chunk:
                    counts[k] = len(splice(t, encode, margin, chunk, overlap))
                    continue
                todo.append(k)
                size += len(t)
                if size >= BATCH:
                    flush()
                    todo, size = [], 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                names=["key", "n_bytes", "n_tokens", "over_limit"])

    importable(docs.sparkSession)
    src = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"),
                      F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("n_bytes"))
    kind = src.schema["key"].dataType.simpleString()
    return src.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("key", key)
