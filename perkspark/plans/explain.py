"""Physical-plan summary of registered queries.

``python -m perkspark.plans.explain [SF_DIR] [QUERY ...]`` prints, per
query, the shuffles, broadcasts, join strategies, windows and scans (with
``ReadSchema`` and ``PushedFilters``) of the executed plan as Markdown.
The plan is taken with AQE off, so the static strategy is what is shown;
at run time AQE may still coalesce partitions, split skew and turn a
shuffle join whose measured side is small into a broadcast.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The physical plan tree as ``df.explain()`` prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def summarize(df: DataFrame) -> dict:
    plan = physical_plan(df)
    # a reused exchange prints the one it reuses on its own line
    own = "\n".join(line for line in plan.splitlines() if "ReusedExchange" not in line)
    exchanges = re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", own)
    scans = re.findall(
        r"FileScan parquet \[[^\]]*\].*?PushedFilters: \[([^\]]*)\].*?ReadSchema: struct<([^>]*)>", plan
    )
    return {
        "shuffles": [re.sub(r"#\d+L?", "", e) for e in exchanges],
        "reused_shuffles": plan.count("ReusedExchange"),
        "broadcasts": own.count("BroadcastExchange"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "broadcast_hash_joins": plan.count("BroadcastHashJoin"),
        "windows": plan.count("Window ["),
        "expands": plan.count("Expand ["),
        "python_udfs": plan.count("BatchEvalPython") + plan.count("ArrowEvalPython"),
        "scans": sorted({(schema, pushed) for pushed, schema in scans}),
    }


def to_markdown(name: str, s: dict) -> str:
    lines = [f"### `{name}`", ""]
    lines.append(
        f"- shuffles: {len(s['shuffles'])} (+{s['reused_shuffles']} reused); broadcasts: {s['broadcasts']}; "
        f"joins: {s['broadcast_hash_joins']} broadcast-hash, {s['sort_merge_joins']} sort-merge; "
        f"windows: {s['windows']}; expands: {s['expands']}; Python UDFs: {s['python_udfs']}"
    )
    for key in sorted(set(s["shuffles"])):
        lines.append(f"- shuffle `{key}` x{s['shuffles'].count(key)}")
    for schema, pushed in s["scans"]:
        lines.append(f"- scan `{schema}`" + (f", pushed `{pushed}`" if pushed else ""))
    return "\n".join(lines) + "\n"


def main(argv: list[str]) -> None:
    sys.path.insert(0, ".")
    from perkspark.plans.registry import QUERIES
    from perkspark.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print(f"# Physical plans (static, AQE off) on `{sf_dir}`\n")
    for name in names:
        print(to_markdown(name, summarize(QUERIES[name](spark, sf_dir))))


if __name__ == "__main__":
    main(sys.argv)
