"""Merkle manifest of a dataset: one hash tree a source, one over the sources, and a proof for every row.

Nodes are labelled with the interval ``[lo, hi)`` of leaf ranks they cover, so
the tree needs no pointers.  A parent of level k covers the ranks with one
value of ``rank div FANOUT ** k``: this bucket joins a node with its parent,
and containment of the intervals confirms it.  A parent's interval less the
node's leaves two intervals; the parent's children inside them are the node's
siblings on the left and on the right.

Ranks come from a range shuffle of (tree, doc_id), so a source with a third of
all rows is many slices.  Texts are hashed in the scan and not moved; a node
gathers ``FANOUT`` children at most.  Leaves are joined with nothing: they stay
with their first parent, one row for ``FANOUT`` leaves, and only such rows meet
the levels above, each a ``FANOUT``-th of the one below.

A tree that has come down to one node passes it on unhashed, so that all trees
end at one height.

Defined results: nulls count as ``-`` in the leaf; a null doc_id stands before
all others of its source and is never tampered with; a null source is a source
of its own; rows of equal doc_id follow their leaf digest; repeated rows are
leaves of their own with equal digests; an empty table has no rows; columns
beyond those of ``documents`` are not hashed; very long texts are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators.ordering import with_position
from specloom.session import cut_lineage

FANOUT = 16
#: One in so many ids is tampered with in the check of the proofs.
TAMPER_EVERY = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each value with its length in bytes before it, so that no two rows read alike."""
    told = []
    for field in fields:
        text = field.cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*told), 256)


def tampered_text(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: c["digest"]), "")


def _grouped(nodes: DataFrame, level: int, *payload: Column) -> DataFrame:
    """Nodes of ``level`` from those of the level below: at most ``FANOUT`` children each, in rank order.

    A tree whose only node is left hands it on: ``alone``.
    """
    width = FANOUT**level
    child = F.struct("lo", "hi", "digest", *payload)
    groups = nodes.groupBy("tree", F.floor(F.col("lo") / F.lit(width)).alias("bucket")).agg(
        F.sort_array(F.collect_list(child)).alias("children")
    )
    alone = (F.col("bucket") == 0) & (F.size("children") == 1)
    return groups.select(
        "tree", "bucket", "children", alone.alias("alone"),
        F.element_at("children", 1)["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
        F.when(alone, F.element_at("children", 1)["digest"]).otherwise(F.sha2(_joined(F.col("children")), 256)).alias("digest"),
    )


def _height(leaves: DataFrame) -> int:
    """Levels above the leaves of the largest tree, one at least; a single number comes to the driver."""
    most = leaves.agg(F.max("hi")).first()[0] or 0
    height = 1
    while FANOUT**height < most:
        height += 1
    return height


def build(leaves: DataFrame, *payload: str) -> list[DataFrame]:
    """All levels above leaves of tree, lo, hi, digest; the first one's children carry ``payload``."""
    levels = [cut_lineage(_grouped(leaves, 1, *map(F.col, payload)))]
    for level in range(2, _height(leaves) + 1):
        levels.append(cut_lineage(_grouped(levels[-1], level)))
    return levels


def _step(parent: str, lo: Column, hi: Column) -> Column:
    """What stands left and right of [lo, hi) in the parent's interval; nothing if the node is alone."""
    children = F.col(f"{parent}.children")
    step = F.struct(
        _joined(F.filter(children, lambda c: c["hi"] <= lo)).alias("left"),
        _joined(F.filter(children, lambda c: c["lo"] >= hi)).alias("right"),
    )
    return F.when(F.col(f"{parent}.alone"), F.array().cast("array<struct<left:string,right:string>>")).otherwise(F.array(step))


def descend(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first level's nodes with ``path``: siblings of each ancestor, from the node's own up.

    ``above`` has tree, path of what lies over each tree's root, and further columns that are handed down.
    """
    rest = [c for c in above.columns if c not in ("tree", "path")]
    paths = levels[-1].join(above, "tree")
    for level in range(len(levels) - 1, 0, -1):
        width = FANOUT ** (level + 1)
        node, parent = levels[level - 1].alias("n"), paths.alias("p")
        same = (
            (F.col("n.tree") == F.col("p.tree"))
            & (F.floor(F.col("n.lo") / F.lit(width)) == F.col("p.bucket"))
            & (F.col("p.lo") <= F.col("n.lo"))
            & (F.col("n.hi") <= F.col("p.hi"))
        )
        paths = node.join(parent, same).select(
            "n.*", F.concat(_step("p", F.col("n.lo"), F.col("n.hi")), F.col("p.path")).alias("path"),
            *[F.col(f"p.{c}") for c in rest],
        )
    return paths


def fold(digest: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, digest, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def _ranked(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    placed = with_position(df, group, order, "hi")
    return placed.withColumn("lo", F.col("hi") - 1)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    ``tampered`` tells the rows whose text is changed before their root is
    folded again; by default those whose CRC of the id is a multiple of ``TAMPER_EVERY``.
    """
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    fields = [F.col(f) for f in FIELDS]
    changed = [*fields[:-1], tampered_text(F.col("text"))]
    hashed = cut_lineage(docs.select(
        "doc_id",
        # sorts like the source, null first
        F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source"))).alias("tree"),
        leaf_digest(fields).alias("digest"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(changed)).alias("changed"),
    ))
    leaves = _ranked(hashed, ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()])
    levels = build(leaves, "doc_id", "changed")
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("digest").alias("subroot"))
    over = build(
        _ranked(subroots, [], [F.col("source").asc()]).withColumnRenamed("subroot", "digest"), "source"
    )
    top = over[-1].select("tree", F.col("digest").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    runs = descend(over, top)
    sources = _opened(runs, "source", "root").select(
        F.col("source").alias("tree"), "path", F.col("digest").alias("subroot"), "root"
    )
    rows = _opened(descend(levels, sources), "doc_id", "changed", "subroot", "root")
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = rows.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        fold(F.coalesce("changed", "digest"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def _opened(runs: DataFrame, *columns: str) -> DataFrame:
    """The leaves of first-level nodes, each with its own path, and ``columns`` of the leaf or of the node."""
    opened = runs.withColumn("leaf", F.explode("children"))
    own = {f.name for f in runs.schema["children"].dataType.elementType.fields}
    step = F.when(
        F.col("alone"), F.array().cast("array<struct<left:string,right:string>>")
    ).otherwise(F.array(F.struct(
        _joined(F.filter("children", lambda c: c["hi"] <= F.col("leaf.lo"))).alias("left"),
        _joined(F.filter("children", lambda c: c["lo"] >= F.col("leaf.hi"))).alias("right"),
    )))
    return opened.select(
        F.col("leaf.digest").alias("digest"), F.concat(step, F.col("path")).alias("path"),
        *[F.col(f"leaf.{c}" if c in own else c).alias(c) for c in columns],
    )


def _sql_crc(value: str) -> str:
    """The unsigned CRC-32 of a short text, bit by bit."""
    steps = f"flatten([[ascii({value}[i]), 0, 0, 0, 0, 0, 0, 0] for i in range(1, length({value}) + 1)])"
    folded = "xor(acc, x)"
    return (
        f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(b AS BIGINT) for b in {steps}]), "
        f"lambda acc, x: xor({folded} >> 1, 3988292384 * ({folded} & 1))), 4294967295)"
    )


def _sql_tree(name: str, leaves: str, levels: int) -> list[str]:
    """CTEs of a tree's levels, from leaves of tree, r, digest; each with the siblings of its nodes."""
    parts = []
    below = leaves
    for level in range(1, levels + 1):
        parts.append(f"""{name}{level} AS (
  SELECT tree, r // {FANOUT} AS r, list(digest ORDER BY r) AS kids,
    CASE WHEN r // {FANOUT} = 0 AND count(*) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY r)) END AS digest
  FROM {below} GROUP BY tree, r // {FANOUT})""")
        below = f"{name}{level}"
    return parts


def oracle(levels: int = 6, source_levels: int = 3) -> str:
    """The same in DuckDB's SQL, for up to 16 ** levels rows a source and 16 ** source_levels sources."""

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(
            f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')"
            for v in (*[f"CAST({f} AS VARCHAR)" for f in FIELDS[:-1]], text)
        ) + ")"

    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    crc = _sql_crc("CAST(doc_id AS VARCHAR)")
    ctes = [
        f"""l AS (
  SELECT doc_id, source, {leaf("text")} AS digest,
    CASE WHEN {crc} % {TAMPER_EVERY} = 0 THEN {leaf(lower)} END AS changed FROM documents)""",
        """t0 AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS r FROM l)""",
        *_sql_tree("t", "t0", levels),
        f"s0 AS (SELECT 0 AS tree, tree - 1 AS r, digest FROM t{levels})",
        *_sql_tree("s", "s0", source_levels),
    ]
    joins, steps = [], []
    for name, count, at in (("t", levels, "t0.r"), ("s", source_levels, "t0.tree - 1")):
        for level in range(1, count + 1):
            node, parent = f"(({at}) // {FANOUT ** (level - 1)})", f"(({at}) // {FANOUT**level})"
            alias = f"{name}{level}"
            own_tree = f"{alias}.tree = t0.tree AND " if name == "t" else ""
            joins.append(f"JOIN {alias} ON {own_tree}{alias}.r = {parent}")
            place = f"({node} % {FANOUT})"
            kids = f"{alias}.kids"
            alone = f"({parent} = 0 AND len({kids}) = 1)"
            steps.append((f"CASE WHEN {alone} THEN NULL ELSE [array_to_string({kids}[:{place}], ''), array_to_string({kids}[{place} + 2:], '')] END"))
    ctes.append(
        f"p AS (SELECT doc_id, t0.digest AS leaf, t{levels}.digest AS subroot, s{source_levels}.digest AS root, "
        f"coalesce(changed, t0.digest) AS start, [{', '.join(steps)}] AS path FROM t0 {' '.join(joins)})"
    )
    at = "start"
    for i in range(1, len(steps) + 1):
        ctes.append(
            f"f{i} AS (SELECT * REPLACE (CASE WHEN path[{i}] IS NULL THEN start ELSE sha256(path[{i}][1] || start || path[{i}][2]) END "
            f"AS {at}) FROM {'p' if i == 1 else f'f{i - 1}'})"
        )
    siblings = "array_to_string([coalesce(v[1] || v[2], '') for v in path], '')"
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root, sha256({siblings}) AS proof_sha256, start AS folded_root, start = root AS verified
FROM f{len(steps)}"""
