"""A Merkle manifest of a table: a digest of each row, of each source and of all, and a proof for every row.

Nodes in order are hashed in runs of three until one remains: first the leaves of a source, then the sources' nodes. A
superblock is a run of consecutive nodes that a few levels reduce to one node, so its size is bounded whatever a source
holds. Upwards, each superblock is reduced by itself, and its node is a row of the next tier, which is smaller by the
size of a superblock. Downwards, the nodes of a superblock are cogrouped with the one row that says what stands outside
it, the siblings on the way from its node to the root: there the local levels are worked out once more, each node's
proof is put together from local and outer siblings, and the row as it is found is folded to the root it leads to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import ranked, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGITS = 64  # of a digest as hex text
NODE = "grp string, pos long, n long, node string"
PROOF = "proof string, places array<int>, sizes array<int>"


@dataclass(frozen=True)
class Shape:
    """How many nodes make a run, and how many levels a superblock has."""

    arity: int = 3
    levels: int = 7

    @property
    def block(self) -> int:
        return self.arity**self.levels

    def height(self, n: int) -> int:
        """Levels from ``n`` nodes of a tier up to one, or up to the next tier."""
        height = 0
        while n > 1 and height < self.levels:
            n, height = -(-n // self.arity), height + 1
        return height


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def layers(nodes: list[str], n: int, shape: Shape) -> list[list[str]]:
    """The nodes of a superblock and of each level above, up to its one node; ``n`` are those of the whole tier."""
    out = [nodes]
    for _ in range(shape.height(n)):
        nodes = ["".join(nodes[i : i + shape.arity]) for i in range(0, len(nodes), shape.arity)]
        nodes = [digest(x) for x in nodes]
        out.append(nodes)
    return out


def proofs(built: list[list[str]], outer: tuple[str, list[int], list[int]], arity: int) -> list[tuple[str, list[int], list[int]]]:
    """For each lowest node: digests of all siblings up to the root, the place in each run, and the sizes of the runs."""
    above = [outer]
    for nodes in reversed(built[:-1]):
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        own = []
        for run, (rest, places, sizes) in zip(runs, above, strict=True):
            for k in range(len(run)):
                own.append(("".join(run[:k] + run[k + 1 :]) + rest, [k, *places], [len(run), *sizes]))
        above = own
    return above


def fold(leaf: str, proof: str, places: list[int], sizes: list[int]) -> str:
    """The root that a leaf leads to with the siblings of a proof."""
    at = 0
    for place, size in zip(places, sizes, strict=True):
        middle, end = at + DIGITS * place, at + DIGITS * (size - 1)
        leaf, at = digest(proof[at:middle] + leaf + proof[middle:end]), end
    return leaf


def leaf_digest(fields: dict[str, Column]) -> Column:
    """SHA-256 of all values, each as its number of bytes, a colon and itself; NULL is a dash."""
    text = {name: value.cast("string") for name, value in fields.items()}
    parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in text.values()]
    return F.sha2(F.concat(*parts), 256)


def _tier(nodes: DataFrame, shape: Shape) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / shape.block))


def reduced(nodes: DataFrame, shape: Shape) -> DataFrame:
    """The next tier: the node of each superblock. A tier of one node stays what it is."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n = int(rows["n"].iloc[0])
        top = layers(rows["node"].tolist(), n, shape)[-1][0]
        return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "n": [-(-n // shape.block)], "node": [top]})

    tier = _tier(nodes.select("grp", "pos", "n", "node"), shape)
    return tier.groupBy("grp", "block").applyInPandas(run, NODE)


def spread(nodes: DataFrame, outer: DataFrame, shape: Shape, carried: str = "") -> DataFrame:
    """Proofs of all nodes of a tier, from the proofs of its superblocks.

    ``outer`` has one row for each superblock: its ``grp`` and ``pos``, its proof, and the digests ``subroot`` and
    ``root`` it stands under. ``carried`` are columns of the nodes that are kept; with ``found`` among them, that leaf is
    folded by the proof to ``folded_root``.
    """
    kept = [c.split(" ")[0] for c in carried.split(", ") if c]
    folds = "found" in kept
    schema = f"{NODE}, {PROOF}, subroot string, root string" + (f", {carried}" if kept else "")
    schema += ", folded_root string" if folds else ""

    def run(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        outside = above.iloc[0]
        built = layers(rows["node"].tolist(), int(rows["n"].iloc[0]), shape)
        own = proofs(built, (outside["proof"], list(outside["places"]), list(outside["sizes"])), shape.arity)
        out = rows[["grp", "pos", "n", "node"]].assign(
            proof=[p for p, _, _ in own],
            places=[p for _, p, _ in own],
            sizes=[s for _, _, s in own],
            subroot=outside["subroot"],
            root=outside["root"],
            **{c: rows[c] for c in kept},
        )
        if folds:
            out["folded_root"] = [fold(x, *p) for x, p in zip(rows["found"], own, strict=True)]
        return out

    tier = _tier(nodes, shape).groupBy("grp", "block")
    outside = outer.withColumnRenamed("pos", "block").select("grp", "block", "proof", "places", "sizes", "subroot", "root")
    return tier.cogroup(outside.groupBy("grp", "block")).applyInPandas(run, schema)


def tiers(nodes: DataFrame, most: int, shape: Shape) -> Iterator[DataFrame]:
    """The tiers above ``nodes``, stored, up to the one in which every group has a single node; no group has more
    nodes than ``most``."""
    while most > 1:
        nodes, most = written(reduced(nodes, shape), "merkle-tier"), -(-most // shape.block)
        yield nodes


def manifest(rows: DataFrame, leaf: Column, found: Column, group: Column, order: list[Column], shape: Shape = Shape()) -> DataFrame:
    """The tree over ``rows`` and the proof of each.

    ``leaf`` is the digest of a row, ``found`` that of the row as it was found later, ``group`` the name of its source
    and ``order`` the place in the source; rows equal in all of these are interchangeable. Returns for each row the
    ``order`` columns (``key_0`` …), ``leaf``, its ``proof`` (digests of the siblings from the leaf upwards), ``places``
    and ``sizes`` (place and size of the run at each level), ``subroot``, ``root`` and ``folded_root``. The types of
    ``order`` must outlast a cast to text, because pandas would turn integers beside a NULL into floats.

    Rows are ranked by a sort by range, so a source that holds a third of them, or one key repeated as often, is split.
    """
    # '-' stands before 's', so NULL comes first, and UTF-8 strings compare by bytes.
    name = F.coalesce(F.concat(F.lit("s"), group.cast("string")), F.lit("-"))
    keys = [c.alias(f"key_{k}") for k, c in enumerate(order)]
    leaves = written(rows.select(name.alias("grp"), *keys, leaf.alias("node"), found.alias("found")), "merkle-leaves")
    names = [f"key_{k}" for k in range(len(order))]
    tied = leaves.withColumn("_row", F.monotonically_increasing_id())
    placed, _ = ranked(tied, ["grp", *names, "node", "found", "_row"])
    groups = written(placed.groupBy("grp").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-groups")
    pos = (F.col("rank") - F.col("first")).alias("pos")
    nodes = placed.join(groups, "grp").select("grp", pos, "n", "node", "found", *[F.col(c).cast("string") for c in names])

    below = [nodes, *tiers(nodes, groups.agg(F.max("n")).first()[0] or 0, shape)]
    order_of_groups, n_groups = ranked(below[-1].select("grp", "node"), ["grp"])
    top = order_of_groups.select(F.lit("").alias("grp"), F.col("rank").alias("pos"), F.lit(n_groups).cast("long").alias("n"), "node", F.col("grp").alias("source"))
    above = [top, *tiers(top, n_groups, shape)]

    roots = [("", 0, "", [], [], None, r.node) for r in above[-1].select("node").collect()]  # one row, none of an empty table
    outer = rows.sparkSession.createDataFrame(roots, f"grp string, pos long, {PROOF}, subroot string, root string")
    for tier in reversed(above[1:-1]):
        outer = spread(tier, outer, shape)
    outer = spread(top, outer, shape, "source string")
    outer = outer.select(F.col("source").alias("grp"), F.lit(0).cast("long").alias("pos"), "proof", "places", "sizes", F.col("node").alias("subroot"), "root")
    for tier in reversed(below[1:-1]):
        outer = spread(tier, outer, shape)
    proved = spread(nodes, outer, shape, ", ".join(["found string", *(f"{c} string" for c in names)]))
    typed = [F.col(c).cast(leaves.schema[c].dataType) for c in names]
    return proved.select(*typed, F.col("node").alias("leaf"), "proof", "places", "sizes", "subroot", "root", "folded_root")


def op13_merkle(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """The manifest of documents, each proved against a copy in which some texts have lost their line breaks.

    NULL values have a sign of their own, so they differ from empty ones; a NULL source is a source that stands first,
    NULL doc_ids stand first in theirs. Rows with one doc_id stand in the order of their digests, repeated rows are
    leaves of their own. Texts of any length are hashed whole. An empty table gives no rows. Only the five named columns
    are read, so others may have any name.
    """
    fields = {c: F.col(c) for c in FIELDS}
    lost = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    cut = F.when(lost, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaf, found = leaf_digest(fields), leaf_digest(fields | {"text": cut})
    proved = manifest(docs, leaf, found, F.col("source"), [F.col("doc_id").cast("long")], shape)
    return proved.select(
        F.col("key_0").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# CRC-32 bit by bit, its lowest bit; then both trees and both ways up, a level in each turn of a recursion.
SQL = """
with recursive bits as (
  select doc_id, source, lang, n_chars, text, flatten(list_transform(string_split(doc_id::varchar, ''),
         lambda c: list_transform(range(8), lambda k: (ascii(c)::ubigint >> k::ubigint) & 1::ubigint))) b from documents),
marked as (
  select *, list_reduce(list_prepend(4294967295::ubigint, b), lambda crc, bit: xor(crc >> 1::ubigint,
         case when xor(crc, bit) & 1::ubigint = 1 then 3988292384::ubigint else 0::ubigint end)) crc from bits),
texts as (
  select *, case when xor(crc, 4294967295::ubigint) & 1::ubigint = 0 then replace(text, chr(10), '') else text end cut,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') head from marked),
leaves as (
  select doc_id, coalesce('s' || source, '-') g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) node,
         sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) found from texts),
placed as (
  select *, row_number() over (order by g, doc_id nulls first, node, found) id,
         row_number() over (partition by g order by doc_id nulls first, node, found) - 1 pos, count(*) over (partition by g) n from leaves),
lower_nodes(g, lvl, pos, n, node) as (
  select g, 0, pos, n, node from placed
  union all
  select g, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' order by pos)) from lower_nodes where n > 1
  group by g, lvl, pos // 3, n),
tops as (select g, row_number() over (order by g) - 1 pos, count(*) over () n, node from lower_nodes where n = 1),
upper_nodes(lvl, pos, n, node) as (
  select 0, pos, n, node from tops
  union all
  select lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' order by pos)) from upper_nodes where n > 1
  group by lvl, pos // 3, n),
lower_way(id, g, lvl, pos, n, found, proof) as (
  select id, g, 0, pos, n, found, '' from placed
  union all
  select w.id, w.g, w.lvl + 1, w.pos // 3, (w.n + 2) // 3,
         sha256(string_agg(case when u.pos = w.pos then w.found else u.node end, '' order by u.pos)),
         w.proof || coalesce(string_agg(case when u.pos <> w.pos then u.node end, '' order by u.pos), '')
  from lower_way w join lower_nodes u on u.g = w.g and u.lvl = w.lvl and u.pos // 3 = w.pos // 3 where w.n > 1
  group by w.id, w.g, w.lvl, w.pos, w.n, w.proof),
upper_way(id, lvl, pos, n, found, proof) as (
  select w.id, 0, t.pos, t.n, w.found, w.proof from lower_way w join tops t on t.g = w.g where w.n = 1
  union all
  select w.id, w.lvl + 1, w.pos // 3, (w.n + 2) // 3,
         sha256(string_agg(case when u.pos = w.pos then w.found else u.node end, '' order by u.pos)),
         w.proof || coalesce(string_agg(case when u.pos <> w.pos then u.node end, '' order by u.pos), '')
  from upper_way w join upper_nodes u on u.lvl = w.lvl and u.pos // 3 = w.pos // 3 where w.n > 1
  group by w.id, w.lvl, w.pos, w.n, w.proof)
select p.doc_id, p.node leaf, t.node subroot, r.node root, sha256(w.proof) proof_sha256, w.found folded_root,
       w.found = r.node verified
from placed p join tops t on t.g = p.g join upper_way w on w.id = p.id and w.n = 1, (select node from upper_nodes where n = 1) r
"""
