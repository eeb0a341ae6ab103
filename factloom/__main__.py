"""Command line: list the queries, run one and write or show its rows, or write the quality report.

    python -m factloom list
    python -m factloom run NAME DATA [--out FOLDER] [--rows 20]
    python -m factloom report DATA FILE

``--more MODULE`` adds the queries of a module that has QUERIES, the optional subpackage's for instance.
"""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.text import percent_text
from .operators import quality
from .plans import evaluation, registry
from .sources.exports import html_report


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="factloom", description=__doc__.splitlines()[0])
    p.add_argument("--more", action="append", default=[])
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("name")
    run.add_argument("data")
    run.add_argument("--out")
    run.add_argument("--rows", type=int, default=20)
    report = sub.add_parser("report")
    report.add_argument("data")
    report.add_argument("file")
    a = p.parse_args(argv)
    queries = registry.queries()
    for module in a.more:
        queries |= import_module(module).QUERIES
    if a.command == "list":
        print("\n".join(sorted(queries)))
        return 0
    spark = SparkSession.builder.appName("factloom").getOrCreate()
    if a.command == "report":
        docs = evaluation.backtest_docs(spark, a.data).checkpoint()
        rows = lambda df: [r.asDict() for r in df.collect()]
        total = quality.corpus_quality(docs).first().asDict()
        causes = [r | {"meaning": quality.CAUSES.get(r["cause"], r["cause"])} for r in rows(quality.causes(docs).orderBy("kind", F.desc("documents"), "cause"))]
        worst = docs.where("category = 'differs'").orderBy(F.desc(F.col("missing") + F.col("extra") + F.col("wrong")), "doc").limit(50)
        shown = worst.select("doc", "stage", "problem", "expected", "predicted", "matched", "wrong", "missing", "extra", "forgiven", percent_text(F.col("recall")).alias("recall"))
        fields = rows(quality.field_quality(docs, list(evaluation.FIELDS)).orderBy("field"))
        html_report(total, fields, a.file, {"Causes and stages": causes, "Documents with most problems": rows(shown)})
        return 0
    if a.name not in queries:
        p.error(f"no query {a.name}; see 'list'")
    df = queries[a.name](spark, a.data)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.rows, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
