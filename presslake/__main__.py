"""Command line: the reference's scripts as Spark jobs.

    python -m presslake harvest --urls input/ --pages landing/pages --out out/ [--site wp_cats]
    python -m presslake records --pages landing/pages --hosts hosts.json --out out/
    python -m presslake links   --pages landing/pages --out out/links
    python -m presslake report  --pages landing/pages --docs landing/documents --out out/report

Run with spark-submit on a cluster (the master comes from spark-submit) or
pass ``--master local[8]``.  Every output is written by Spark (no driver-side
collection); only the small per-site summary is printed.
"""

from __future__ import annotations

import argparse
import json
import os


def _spark(args):
    from presslake.session import get_spark
    return get_spark(args.master, app=f"presslake-{args.cmd}")


def cmd_harvest(args):
    from pyspark.sql import functions as F

    from presslake.functions.text import path_tail_name
    from presslake.operators import nodes as N
    from presslake.operators import sites
    from presslake.operators.harvest import harvest, harvest_report
    from presslake.sources import sinks
    from presslake.sources.readers import read_url_list
    from presslake.sources.tables import spread
    spark = _spark(args)
    urls = read_url_list(spark, args.urls)
    pages = spread(spark.read.parquet(args.pages))
    arts = harvest(urls.select("url", "pos"), pages)
    if args.site:
        # node path: the site's own spec replaces the generic fields
        got = pages.select("page_id", "url", "html")
        spec = sites.render_sentinels(sites.site_articles(got, N.shred(got), args.site), args.site)
        arts = arts.select("url", "status", "outcome", "page_id").join(spec.drop("url"), "page_id", "left")
    # Extraction runs once: the manifest and the summary read the written records.
    arts = arts.drop("page_id", "url_key")
    path = os.path.join(args.out, "articles")
    sinks.write_jsonl(arts, path)
    arts = spark.read.schema(arts.schema).json(path)
    written = ["articles", "summary"]
    if "image_url" in arts.columns:
        manifest = arts.where(F.col("image_url").isNotNull()).select("url", "image_url", path_tail_name("image_url", 3).alias("file_name"))
        manifest.write.mode("overwrite").parquet(os.path.join(args.out, "asset_manifest"))
        written.append("asset_manifest")
    report = harvest_report(arts) if not args.site else arts.groupBy("outcome").count()
    report.write.mode("overwrite").json(os.path.join(args.out, "summary"))
    print(json.dumps({"out": args.out, "written": sorted(written)}))


def cmd_records(args):
    from presslake.operators import sites
    from presslake.sources import sinks
    from presslake.sources.tables import spread
    spark = _spark(args)
    with open(args.hosts) as f:
        hosts = json.load(f)
    records, seen = sites.observed(sites.site_records(spread(spark.read.parquet(args.pages)), hosts))
    path = os.path.join(args.out, "records")
    sinks.write_jsonl(sites.render_sentinels(records), path)
    written = spark.read.schema(records.schema).json(path)
    sites.image_manifest(written).write.mode("overwrite").parquet(os.path.join(args.out, "images"))
    print(json.dumps({"out": args.out, **seen.get}))


def cmd_links(args):
    from presslake.operators.extract import page_links
    from presslake.sources import sinks
    from presslake.sources.tables import spread
    spark = _spark(args)
    links = page_links(spread(spark.read.parquet(args.pages)), absolute=True)
    sinks.write_url_list(links.select("abs_url"), args.out, col="abs_url")
    print(json.dumps({"out": args.out}))


def cmd_report(args):
    from presslake.operators.corpus import detect_lang
    from presslake.operators.extract import extract_articles
    from presslake.operators.quality import field_completeness
    from presslake.sources.tables import spread
    spark = _spark(args)
    arts = extract_articles(spread(spark.read.parquet(args.pages)))
    field_completeness(arts, "lang", ["title", "headline", "first_paragraph"]).write.mode("overwrite").json(
        os.path.join(args.out, "completeness"))
    if args.docs:
        docs = spread(spark.read.parquet(args.docs))
        detect_lang(docs.select("doc_id", "text"), "text").groupBy("lang_detected").count().write.mode(
            "overwrite").json(os.path.join(args.out, "languages"))
    print(json.dumps({"out": args.out}))


def main(argv=None):
    ap = argparse.ArgumentParser(prog="presslake")
    ap.add_argument("--master", default=None, help="Spark master (omit under spark-submit)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    h = sub.add_parser("harvest", help="URL list + landed pages → article JSONL, asset manifest, summary")
    h.add_argument("--urls", required=True)
    h.add_argument("--pages", required=True)
    h.add_argument("--out", required=True)
    h.add_argument("--site", default=None, help="site spec name (node path), e.g. wp_cats")
    rc = sub.add_parser("records", help="landed pages of many sites → records by each host's spec, image manifest, outcome counts")
    rc.add_argument("--pages", required=True)
    rc.add_argument("--hosts", required=True, help="JSON file: host → site spec name")
    rc.add_argument("--out", required=True)
    lk = sub.add_parser("links", help="listing links of landed pages → URL list")
    lk.add_argument("--pages", required=True)
    lk.add_argument("--out", required=True)
    r = sub.add_parser("report", help="field completeness and language report")
    r.add_argument("--pages", required=True)
    r.add_argument("--docs", default=None)
    r.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    {"harvest": cmd_harvest, "records": cmd_records, "links": cmd_links, "report": cmd_report}[args.cmd](args)


if __name__ == "__main__":
    main()
