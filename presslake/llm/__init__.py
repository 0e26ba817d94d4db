"""Training-data operators: language, near-copies, quality, packing, search.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Every
operator is a function ``DataFrame -> DataFrame``; :mod:`presslake.llm.queries`
applies each one, with its production parameters, to its whole table.
"""
