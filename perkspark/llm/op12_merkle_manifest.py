"""Merkle manifest of a dataset: a content-addressed DAG and proofs by descent.

A row's leaf is the digest of its fields; the leaves of a source, in id order,
are joined in runs of ``FANOUT`` until one node, the source's subroot, remains,
and the subroots, in source order, are joined likewise up to the root.

*Ranks* are dealt without a task that sees a whole source: rows are sorted by
range over (source, id, leaf), numbered inside their partition, and the counts of
the partitions before are added (``ranked``).  *Growing* joins a level's runs to
the next level's nodes; every level's digest-to-children records are stored once a
digest.  *Descent* starts with a request for each tree's top digest: the records
of its height are looked up by digest, every requested rank's digit chooses a
child, the children not chosen go into the path, and the child is the next
request.  Requests that share a prefix of digits travel as one row down to the
leaf runs, so the work of a level follows its nodes, and no digest is asked for
by all rows.  At a leaf the segments, gathered from the root, are reversed.

All steps are built-in DataFrame functions; the only thing the driver learns is
the size of the largest tree.

Defined cases: a null field is written ``-``; a null doc_id sorts first, ties in a
source go by leaf digest (rows with equal leaves are interchangeable); repeated
rows are leaves of their own; null is a source like any other; an empty text is
``0:``; very long texts are hashed whole in the scan and never shuffled; an empty
table gives no rows; columns but the five hashed ones are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose crc32 of the id is divisible by this are tampered with by the query.
TAMPER_EVERY = 5
#: fixed values: the letters that tampering (and other operators' keys) lower-case
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row's fields, each ``-`` if null, else its bytes' number, a colon and the bytes."""
    fields = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(*fields)


def ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in their ``tree`` by the columns ``by``, and ``size``, the tree's rows.

    Equal rows are told apart by the place they are read at, so that many of them
    still spread over the partitions of the range sort.
    """
    order = [F.col(c).asc_nulls_first() for c in ["tree", *by, "_place"]]
    apart = rows.withColumn("_place", F.monotonically_increasing_id())
    parts = apart.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id's lower 33 bits count the rows of a partition
    numbered = parts.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    dealt = written(numbered, "merkle-dealt")
    pieces = dealt.groupBy(F.col("_part").alias("_p"), F.col("tree").alias("_t")).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    of_tree = Window.partitionBy("_t")
    before = F.sum("_n").over(of_tree.orderBy("_p")) - F.col("_n")
    pieces = pieces.select("_p", "_t", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(of_tree).alias("size"))
    placed = dealt.join(pieces, (F.col("_part") == F.col("_p")) & F.col("tree").eqNullSafe(F.col("_t")))
    return placed.select(*rows.columns, (F.col("_place") + F.col("_shift")).alias("rank"), "size")


def runs_of(leaves: DataFrame, fanout: int) -> DataFrame:
    """(tree, size, run, members) of leaves (tree, size, rank, digest, ...), members in rank order."""
    others = [c for c in leaves.columns if c not in ("tree", "size")]
    members = F.struct("rank", *(c for c in others if c != "rank"))
    runs = leaves.groupBy("tree", "size", F.floor(F.col("rank") / fanout).alias("run")).agg(F.sort_array(F.collect_list(members)).alias("members"))
    return written(runs, "merkle-runs")


class Forest:
    """Trees over ``runs_of`` leaves: their tops (tree, size, rank, digest) and digest-to-children records by height."""

    def __init__(self, runs: DataFrame, fanout: int = FANOUT):
        self.fanout = fanout
        largest = runs.agg(F.max("size")).first()[0] or 0
        level = runs.select("tree", "size", F.col("run").alias("rank"), F.transform("members", lambda m: m["digest"]).alias("children"))
        tops = [level.filter("size = 1").select("tree", "size", "rank", F.element_at("children", 1).alias("digest"))]
        self.records: dict[int, DataFrame] = {}
        height = 0
        while fanout**height < largest:
            height += 1
            if height > 1:  # at most ``fanout`` members are gathered
                members = F.sort_array(F.collect_list(F.struct("rank", "digest")))
                level = (
                    nodes.filter(F.col("size") > fanout ** (height - 1))
                    .groupBy("tree", "size", F.floor(F.col("rank") / fanout).alias("rank"))
                    .agg(F.transform(members, lambda m: m["digest"]).alias("children"))
                )
            joined = level.filter("size > 1").withColumn("digest", F.sha2(F.array_join("children", ""), 256))
            nodes = written(joined, f"merkle-nodes-{height}")
            self.records[height] = nodes.select("digest", "children").dropDuplicates(["digest"])
            nodes = nodes.select("tree", "size", "rank", "digest")
            tops.append(nodes.filter(F.col("size") <= fanout**height))
        self.tops = reduce(DataFrame.unionByName, tops)

    def requests(self, tops: DataFrame, height: int) -> DataFrame:
        """Requests for the tops of the trees of that height."""
        low = self.fanout ** (height - 1) if height else 0
        return tops.filter((F.col("size") > low) & (F.col("size") <= self.fanout**height))

    def descend(self, tops: DataFrame, wanted: DataFrame | None = None, leaf_runs: bool = False) -> DataFrame:
        """From ``tops`` (tree, size, rank, digest, path, ...) to the leaves, or to the children of the leaf runs.

        ``path`` gains a segment (the run's children before and after the chosen
        one) for each level, the root's first.  ``wanted`` (tree, rank) restricts the
        descent to some leaves.  With ``leaf_runs`` the rows are the runs of leaves
        with their ``children``; trees of one leaf have none.
        """
        at = None
        for height in sorted(self.records, reverse=True):
            start = self.requests(tops, height)
            at = start if at is None else at.unionByName(start)
            opened = at.join(self.records[height], "digest")
            if leaf_runs and height == 1:
                at = opened
                break
            keep = [c for c in at.columns if c not in ("digest", "rank", "path")]
            chosen = opened.select(*keep, "rank", "path", "children", F.posexplode("children").alias("digit", "digest"))
            siblings = F.struct(
                F.array_join(F.slice("children", F.lit(1), F.col("digit")), "").alias("before"),
                F.array_join(F.slice("children", F.col("digit") + 2, F.lit(self.fanout)), "").alias("after"),
            )
            step = chosen.select(
                *keep, "digest", (F.col("rank") * self.fanout + F.col("digit")).alias("rank"), F.concat("path", F.array(siblings)).alias("path")
            )
            if wanted is not None:
                prefixes = wanted.select(F.col("tree").alias("_t"), F.floor(F.col("rank") / self.fanout ** (height - 1)).alias("_r")).distinct()
                step = step.join(prefixes, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("rank") == F.col("_r")), "left_semi")
            at = written(step.select(*tops.columns), f"merkle-descent-{height}")
        single = self.requests(tops, 0)
        if leaf_runs:
            single = single.withColumn("children", F.lit(None).cast("array<string>"))
        return single if at is None else at.unionByName(single)


NO_PATH = "array<struct<before:string,after:string>>"


def manifest(docs: DataFrame, altered: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``altered`` is the text that a row is found with when its proof is checked
    (default: its own).  ``proof_sha256`` hashes the siblings from the leaf's run up to
    the root's; ``folded_root`` is the root that follows from the found row's leaf and
    these siblings, ``verified`` whether it is the manifest's.
    """
    found = F.lit(None).cast("string") if altered is None else leaf_digest(text=altered)
    hashed = docs.select(*FIELDS).select("doc_id", F.col("source").alias("tree"), leaf_digest().alias("digest"), found.alias("found"))
    # most rows are as they were: only other leaves are kept
    changed = F.when(F.col("found") != F.col("digest"), F.col("found"))
    leaves = written(hashed.withColumn("found", changed), "merkle-leaves")
    leaves = ranked(leaves, ["doc_id", "digest"])
    runs = runs_of(leaves, fanout)
    forest = Forest(runs, fanout)

    subroots = forest.tops.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    crown_leaves = written(ranked(subroots, ["source"]), "merkle-subroots")
    crown = Forest(runs_of(crown_leaves.drop("source"), fanout), fanout)
    top = crown.tops.select("tree", "size", "rank", "digest", F.array().cast(NO_PATH).alias("path"), F.col("digest").alias("root"))
    placed = crown.descend(top).select("rank", "path", "root", F.col("digest").alias("subroot"))
    of_source = crown_leaves.select(F.col("rank").alias("_rank"), F.col("source").alias("tree"))
    sources = placed.join(of_source, F.col("rank") == F.col("_rank")).drop("rank", "_rank")
    sizes = forest.tops.select(F.col("tree").alias("_t"), "size", "rank", "digest")
    starts = written(sources.join(sizes, F.col("tree").eqNullSafe(F.col("_t"))).drop("_t"), "merkle-starts")

    opened = forest.descend(starts, leaf_runs=True).drop("size", "digest")
    at = runs.select(F.col("tree").alias("_t"), "run", "members").join(opened, F.col("_t").eqNullSafe(F.col("tree")) & (F.col("run") == F.col("rank")))
    upward = F.reverse("path")
    above = F.array_join(F.transform(upward, lambda s: F.concat(s["before"], s["after"])), "")
    each = at.select(upward.alias("upward"), above.alias("above"), "children", "subroot", "root", F.posexplode("members").alias("digit", "m"))
    # a source of one leaf has no run: its leaf is its subroot
    around = lambda first, n: F.coalesce(F.array_join(F.slice("children", first, n), ""), F.lit(""))
    before, after = around(F.lit(1), F.col("digit")), around(F.col("digit") + 2, F.lit(fanout))
    each = each.withColumns({"before": before, "after": after, "own": F.coalesce("m.found", "m.digest")})
    bottom = F.when(F.col("children").isNull(), F.col("own")).otherwise(digest(F.col("before"), F.col("own"), F.col("after")))
    return each.select(
        "m.doc_id",
        F.col("m.digest").alias("leaf"),
        "subroot",
        "root",
        digest(F.col("before"), F.col("after"), F.col("above")).alias("proof_sha256"),
        F.aggregate("upward", bottom, lambda node, s: digest(s["before"], node, s["after"])).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all ``documents`` and every row's proof, a fifth of the rows tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    lowered = F.translate("text", UPPER, LOWER)
    return manifest(table(spark, sf_dir, "documents"), F.when(tampered, lowered).otherwise(F.col("text")))


def _oracle_sql(levels: int = 6, crown_levels: int = 4) -> str:
    """The same in DuckDB, a sub-query for each level (up to 16 ** levels rows a source)."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    # bytes of the id, each followed by eight shifts (-1)
    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda a, b: {step}), 4294967295)"
    parts = [
        f"leaves AS (SELECT doc_id, source AS tree, {leaf('text')} AS leaf, {leaf('altered')} AS found FROM "
        f"(SELECT *, CASE WHEN {crc} % 5 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS altered FROM documents))",
        "n0 AS (SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, "
        "count(*) OVER (PARTITION BY tree) AS size FROM leaves)",
    ]

    def grow(n: str, top: int) -> str:
        tops = [f"SELECT tree, digest FROM {n}0 WHERE size = 1"]
        for h in range(1, top + 1):
            parts.append(
                f"{n}{h} AS (SELECT tree, size, rank // 16 AS rank, sha256(string_agg(digest, '' ORDER BY rank)) AS digest, "
                f"list(digest ORDER BY rank) AS kids FROM {n}{h - 1} WHERE size > {16 ** (h - 1)} GROUP BY tree, size, rank // 16)"
            )
            tops.append(f"SELECT tree, digest FROM {n}{h} WHERE size > {16 ** (h - 1)} AND size <= {16**h}")
        return " UNION ALL ".join(tops)

    def climb(n: str, p: str, top: int) -> None:
        for h in range(1, top + 1):
            at = f"CAST((p.r // {16 ** (h - 1)}) % 16 AS INTEGER)"
            left, right = f"array_to_string(k.kids[1:{at}], '')", f"array_to_string(k.kids[{at} + 2:16], '')"
            parts.append(
                f"{p}{h} AS (SELECT p.* REPLACE (CASE WHEN k.kids IS NULL THEN cur ELSE sha256({left} || cur || {right}) END AS cur, "
                f"CASE WHEN k.kids IS NULL THEN proof ELSE proof || {left} || {right} END AS proof) FROM {p}{h - 1} p "
                f"LEFT JOIN {n}{h} k ON k.tree IS NOT DISTINCT FROM p.t AND k.rank = p.r // {16**h})"
            )

    parts.append(f"subroots AS ({grow('n', levels)})")
    parts.append("c0 AS (SELECT 0 AS tree, tree AS source, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS rank, count(*) OVER () AS size FROM subroots)")
    parts.append(f"roots AS ({grow('c', crown_levels)})")
    parts.append("p0 AS (SELECT doc_id, leaf, tree, tree AS t, rank AS r, found AS cur, '' AS proof FROM n0)")
    climb("n", "p", levels)
    parts.append(f"q0 AS (SELECT p.* REPLACE (0 AS t, c.rank AS r), c.digest AS subroot FROM p{levels} p JOIN c0 c ON c.source IS NOT DISTINCT FROM p.tree)")
    climb("c", "q", crown_levels)
    return (
        "WITH " + ", ".join(parts) + " SELECT doc_id, leaf, subroot, roots.digest AS root, sha256(proof) AS proof_sha256, "
        f"cur AS folded_root, cur = roots.digest AS verified FROM q{crown_levels}, roots"
    )


ORACLE_SQL = _oracle_sql()
