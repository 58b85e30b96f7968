"""Merkle manifest of a table: one digest for all rows, one per source, and a proof for each row.

Rows are leaves in the order of their id within a source, nodes of a level are runs of ``FANOUT`` of the level
below. A level is one aggregation: a conditional maximum per slot spreads a parent's children into columns, whose
concatenation is hashed. On the way down the same columns without the own slot are a node's siblings. Only digests
travel; a text is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberlake.llm.common import remainder, table, written

FANOUT = 16
TAMPERED = 5  # ids whose crc32 this divides are checked with a changed text
RANGE_ROWS = 20_000  # rows of one range of the order, about: what one window holds
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLOTS = [f"c{k}" for k in range(FANOUT)]
STEP = "struct<before:string,after:string>"  # digests left and right of a node in its run


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def placed(rows: DataFrame, group: str, order: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``place``, from 0 in ``order`` within ``group``, and ``n``, the group's number of rows.

    Rows are dealt by ranges of (group, order) that Spark samples, so a large group spans many ranges. A window
    numbers each range; the numbers of rows per range are summed up per group, a few rows each.
    """
    parts = max(1, -(-rows.count() // range_rows))
    dealt = rows.repartitionByRange(parts, group, *order).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    counts = dealt.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows"))
    along = Window.partitionBy(group).orderBy("part")
    before = F.coalesce(F.sum("rows").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(group, "part", before.alias("start"), F.sum("rows").over(Window.partitionBy(group)).alias("n"))
    within = F.row_number().over(Window.partitionBy("part", group).orderBy(*order)) - 1
    numbered = dealt.withColumn("inside", within).join(starts, [group, "part"])
    return numbered.withColumn("place", F.col("start") + F.col("inside")).drop("part", "start", "inside")


def parents(nodes: DataFrame) -> DataFrame:
    """The level above (grp, place, n, digest): the same, and each parent's children in one column per slot."""
    slot = F.pmod("place", F.lit(FANOUT))
    dealt = nodes.select("grp", F.expr(f"place div {FANOUT}").alias("place"), "n", slot.alias("slot"), "digest")
    children = [F.max(F.when(F.col("slot") == k, F.col("digest"))).alias(c) for k, c in enumerate(SLOTS)]
    grouped = dealt.groupBy("grp", "place", "n").agg(*children)
    above = F.expr(f"(n + {FANOUT - 1}) div {FANOUT}")
    return grouped.select("grp", "place", above.alias("n"), digest(F.concat_ws("", *SLOTS)).alias("digest"), *SLOTS)


def tree(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels above (grp, place, n, digest), lowest first, and (grp, digest) of what remains of each group.

    There are as many levels as the largest group needs; a smaller group takes part in the lower ones only.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels, nodes = [], leaves
    tops = nodes.where("n = 1").select("grp", "digest")
    while largest > 1:
        levels.append(written(parents(nodes.where("n > 1")), "level"))
        nodes, largest = levels[-1].select("grp", "place", "n", "digest"), -(-largest // FANOUT)
        tops = tops.unionByName(nodes.where("n = 1").select("grp", "digest"))
    return levels, tops


def siblings(slot: Column) -> Column:
    """The other children's digests, those left and those right of the own slot."""
    before = F.concat_ws("", *[F.when(F.lit(k) < slot, F.col(c)) for k, c in enumerate(SLOTS)])
    after = F.concat_ws("", *[F.when(F.lit(k) > slot, F.col(c)) for k, c in enumerate(SLOTS)])
    return F.struct(before.alias("before"), after.alias("after"))


def leaf_paths(leaves: DataFrame, levels: list[DataFrame], above: DataFrame, carried: list[str]) -> DataFrame:
    """``leaves`` with ``path``, the siblings on the way up, lowest first, and the ``carried`` columns of ``above``.

    ``above`` has grp, path (from the group's top on) and ``carried``. A level is joined with the one below by
    the parent's place, so a key has at most ``FANOUT`` rows. The lowest level is joined with the leaves themselves.
    """
    known = None
    for level in reversed(levels):
        tops = level.where("n = 1").join(above, "grp")
        rows = tops if known is None else tops.unionByName(level.where("n > 1").join(known, ["grp", "place"]))
        known = rows
        if level is not levels[0]:
            pairs = F.explode(F.sequence(F.lit(0), F.lit(FANOUT - 1))).alias("slot")
            slots = rows.select("*", pairs).where(F.get(F.array(*SLOTS), F.col("slot")).isNotNull())
            known = slots.select(
                "grp", (F.col("place") * FANOUT + F.col("slot")).alias("place"),
                F.concat(F.array(siblings(F.col("slot"))), F.col("path")).alias("path"), *carried,
            )
            known = written(known, "paths")
    alone = leaves.where("n = 1").join(above, "grp")
    if known is None:
        return alone
    lowest = known.select("grp", F.col("place").alias("parent"), "path", *carried, *SLOTS)
    own = leaves.where("n > 1").withColumn("parent", F.expr(f"place div {FANOUT}")).join(lowest, ["grp", "parent"])
    step = siblings(F.pmod("place", F.lit(FANOUT)).cast("int"))
    own = own.withColumn("path", F.concat(F.array(step), F.col("path"))).drop("parent", *SLOTS)
    return own.unionByName(alone.select(own.columns))


def manifest(docs: DataFrame, tampered: Column, changed: Column) -> DataFrame:
    """Digest of each row, of its source and of all, its proof, and whether the proof holds for the row as it is now.

    ``docs`` has doc_id, source, lang, n_chars and text; further columns are ignored. Where ``tampered`` holds the
    row is checked with the text ``changed`` instead. Returns doc_id, leaf, subroot, root, proof_sha256, folded_root
    and verified, one row per row.

    Null in any column is the field ``-``, an empty text the field ``0:``. Null source: a source of its own, before
    all others; null doc_id: before all others of its source, never tampered by the query. Rows with one doc_id stand
    in the order of their digests; rows alike in all columns are leaves of their own with equal digests, in any order.
    Very long texts are hashed whole. A lone leaf is its source's digest, a lone source's digest is the root, with a
    proof of no siblings. An empty table gives an empty result.
    """
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")]
    row = digest(*map(field, [*fields, F.col("text")]))
    now = F.when(F.coalesce(tampered, F.lit(False)), digest(*map(field, [*fields, changed])))
    group = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("source")))
    leaves = docs.select("doc_id", group.alias("grp"), row.alias("leaf"), now.alias("now"))
    # the number tells equal rows apart, so that ranges can part them
    leaves = written(leaves.withColumn("nr", F.monotonically_increasing_id()), "leaves")
    leaves = placed(leaves, "grp", ["doc_id", "leaf", "nr"]).drop("nr")
    leaves = written(leaves.withColumn("digest", F.col("leaf")), "placed")
    levels, tops = tree(leaves)
    sources = written(tops.withColumnRenamed("grp", "source_key"), "subroots")
    nodes = placed(sources.withColumn("grp", F.lit("")), "grp", ["source_key"])
    nodes = written(nodes, "sources")
    source_levels, roots = tree(nodes)
    nothing = F.array().cast(f"array<{STEP}>").alias("path")
    root = roots.select("grp", F.col("digest").alias("root"), nothing)
    of_sources = leaf_paths(nodes, source_levels, root, ["root"])
    above = of_sources.select(F.col("source_key").alias("grp"), F.col("digest").alias("subroot"), "root", "path")
    rows = leaf_paths(leaves.drop("digest"), levels, written(above, "source-paths"), ["subroot", "root"])
    folded = F.aggregate("path", F.coalesce("now", "leaf"), lambda below, s: digest(s["before"], below, s["after"]))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    found = rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_slot_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    return manifest(docs, remainder(F.col("doc_id"), TAMPERED) == 0, F.translate("text", UPPER, LOWER))


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    codes = f"list_transform(range(1, len({text}) + 1), lambda i: ascii(substring({text}, i, 1))::BIGINT)"
    shift = "lambda x, k: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"lambda crc, code: list_reduce(list_prepend(xor(crc, code), range(8)), {shift})"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), {byte}), 4294967295)"


def _level_sql(name: str, k: int) -> str:
    """Level ``k`` (grp, place, n, digest), made from the one below, with what is left and right of a node in its run."""
    run = f"PARTITION BY grp, place // {FANOUT} ORDER BY place ROWS BETWEEN"
    joined = "coalesce(string_agg(digest, '') OVER ({} {}), '')"
    before = joined.format(run, "UNBOUNDED PRECEDING AND 1 PRECEDING")
    after = joined.format(run, "1 FOLLOWING AND UNBOUNDED FOLLOWING")
    hashed = "sha256(string_agg(digest, '' ORDER BY place))"
    above = f"""(SELECT grp, place // {FANOUT} AS place, (any_value(n) + {FANOUT - 1}) // {FANOUT} AS n,
        CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE {hashed} END AS digest
        FROM {name}{k - 1} GROUP BY grp, place // {FANOUT})"""
    return f"{name}{k} AS MATERIALIZED (SELECT *, {before} AS before, {after} AS after FROM {above if k else name})"


def _sql(depth: int, source_depth: int) -> str:
    """``depth`` levels within a source and ``source_depth`` above; spare levels change nothing."""
    encoded = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    fixed = " || ".join(map(encoded, ("doc_id", "source", "lang", "n_chars")))
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    steps = [(f"l{k}", f"l{k}.grp = f.grp AND l{k}.place = f.place // {FANOUT**k}") for k in range(depth)]
    steps += [(f"s{k}", f"s{k}.place = f.source_place // {FANOUT**k}") for k in range(source_depth)]
    folds = [
        f"""f{k + 1} AS (SELECT f.* REPLACE (proof || before || after AS proof,
        CASE WHEN {level}.n = 1 THEN f.digest ELSE sha256(before || f.digest || after) END AS digest)
        FROM f{k} f JOIN {level} ON {on})"""
        for k, (level, on) in enumerate(steps)
    ]
    return f"""WITH leaves AS (SELECT doc_id, row_number() OVER () AS nr,
    CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS grp, sha256({fixed} || {encoded("text")}) AS leaf,
    CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % {TAMPERED} = 0
        THEN sha256({fixed} || {encoded(lowered)}) END AS now FROM documents),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, nr) - 1 AS place,
    count(*) OVER (PARTITION BY grp) AS n FROM leaves),
l AS (SELECT grp, place, n, leaf AS digest FROM p),
{", ".join(_level_sql("l", k) for k in range(depth + 1))},
s AS (SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n, digest, grp AS source_key
    FROM l{depth}),
{", ".join(_level_sql("s", k) for k in range(source_depth + 1))},
f0 AS (SELECT p.doc_id, p.leaf, p.grp, p.place, s.place AS source_place, s.digest AS subroot, '' AS proof,
    coalesce(p.now, p.leaf) AS digest FROM p JOIN s ON s.source_key = p.grp),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, f.digest AS folded_root,
    f.digest = r.digest AS verified
FROM f{len(steps)} f CROSS JOIN (SELECT digest FROM s{source_depth}) r"""


SQL = _sql(8, 6)
