"""Merkle manifest of a table: leaves, proofs and their check, by cogrouped subtree exchange.

Every row is a leaf; the leaves of a source, in order, form a tree of runs of
``RUN``, and the sources' subroots form one of the same kind up to the root.

*Order.*  Leaves are range-sorted by (source, id, leaf); positions come from
counts per range partition, so a source of any size is spread over many tasks.

*Up.*  A superblock is a whole subtree of ``BLOCK`` consecutive nodes of a tree.
Superblocks are reduced in ``applyInPandas``; their tops are the nodes of the
next round, which is smaller by ``BLOCK``, until one node of each tree is left.
Then the same is done once more over the subroots.

*Down.*  The top round's proofs are known; each round hands every superblock the
outer nodes its members need: the siblings on the way from its top to the root.
Members and outer nodes are cogrouped by superblock in ``applyInPandas``, which
reduces the superblock again, joins inner and outer siblings to proofs and, in
the round of the leaves, folds every (tampered) leaf up to a root.

Small trees share a superblock group: a group holds the superblocks that start
in one window of ``BLOCK`` positions, so it has fewer than twice ``BLOCK``
members whatever the number of sources.  No task sees more than its groups; the
driver sees whether a round has more to do.  The prefix sums over partitions are
a window of as many rows as there are shuffle partitions.

Defined cases: a null in any column is ``-`` in its leaf; null sources and ids
come first; rows with equal source and id are ordered by leaf; repeated rows are
leaves of their own; a null id is not tampered with; an empty table gives an
empty result; other columns than the five are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import stored
from lakeshift.session import ship_package

RUN = 16
LEVELS = 2
#: Members of a superblock: a subtree of ``LEVELS`` levels.
BLOCK = RUN**LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: One in so many rows (by the checksum of its id) is tampered with.
TAMPER_EVERY = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """The digest of a row's values, each ``-`` if null, else its UTF-8 length, ``:`` and itself."""
    put = [F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in values]
    return F.sha2(F.concat(*put), 256)


def steps(n: int) -> int:
    """Levels that a superblock of a tree of ``n`` nodes is reduced by."""
    k = 0
    while n > 1 and k < LEVELS:
        n, k = -(-n // RUN), k + 1
    return k


def climbed(nodes: list[str], levels: int) -> list[list[str]]:
    """``nodes`` and the ``levels`` levels over them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i : i + RUN])) for i in range(0, len(below), RUN)])
    return out


def siblings(levels: list[list[str]], i: int) -> tuple[list[str], list[str]]:
    """The joined siblings before and after member ``i`` and its ancestors, below the top level."""
    before, after = [], []
    for nodes in levels[:-1]:
        a = i - i % RUN
        before.append("".join(nodes[a:i]))
        after.append("".join(nodes[i + 1 : a + RUN]))
        i //= RUN
    return before, after


def _superblocks(members: pd.DataFrame) -> Iterator[tuple[tuple[int, int], pd.DataFrame, int]]:
    """((tree, block), members in order, nodes of the tree) for every superblock of a group."""
    members = members.sort_values(["tree", "rank"], kind="stable")
    for key, block in members.groupby([members["tree"], members["rank"] // BLOCK], sort=False):
        yield key, block, int(block["n"].iloc[0])


NODES = "tree long, start long, rank long, n long, node string"


def _reduced(members: pd.DataFrame) -> pd.DataFrame:
    out = []
    for (tree, block), rows, n in _superblocks(members):
        top = climbed(rows["node"].tolist(), steps(n))[-1]
        out.append((tree, rows["start"].iloc[0], block, 1 if n <= BLOCK else -(-n // BLOCK), top[0]))
    return pd.DataFrame(out, columns=["tree", "start", "rank", "n", "node"])


OUTER = "tree long, start long, block long, before array<string>, after array<string>, subroot string, root string"


def _proofs(members: pd.DataFrame, outer: pd.DataFrame) -> Iterator[tuple[object, list[str], list[str], object]]:
    """(member, siblings before, siblings after, outer row) for every member of a group, level by level up to the root."""
    beyond = {(o.tree, o.block): o for o in outer.itertuples(index=False)}
    for key, rows, n in _superblocks(members):
        levels, above = climbed(rows["node"].tolist(), steps(n)), beyond[key]
        for i, member in enumerate(rows.itertuples(index=False)):
            before, after = siblings(levels, i)
            yield member, before + list(above.before), after + list(above.after), above


def _placed(members: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The outer nodes that the superblocks of the round below need: one row per member, which is such a superblock's top."""
    out = [(m.tree, m.start, m.rank, b, a, o.subroot, o.root) for m, b, a, o in _proofs(members, outer)]
    return pd.DataFrame(out, columns=["tree", "start", "block", "before", "after", "subroot", "root"])


FOLDED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _folded(members: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    out = []
    for m, before, after, o in _proofs(members, outer):
        folded = m.node if m.tampered is None else m.tampered
        for b, a in zip(before, after, strict=True):
            folded = digest(b + folded + a)
        proof = digest("".join(b + a for b, a in zip(before, after, strict=True)))
        doc_id = None if pd.isna(m.doc_id) else int(m.doc_id)
        out.append((doc_id, m.node, o.subroot, o.root, proof, folded, folded == o.root))
    frame = pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return frame.astype({"doc_id": "Int64"})


def _group(block: Column, level: int) -> Column:
    """The group of a superblock of round ``level``: the window of positions in which it starts."""
    span = BLOCK ** (level + 1)
    return F.floor((F.col("start") + block * F.lit(span)) / F.lit(span)).cast("long")


def _grouped(nodes: DataFrame, level: int) -> DataFrame:
    return nodes.withColumn("grp", _group(F.floor(F.col("rank") / BLOCK), level))


def rise(nodes: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """The nodes of every round, and for every round the roots of the trees that end in it (tree, start, node)."""
    rounds, ended = [], []
    while True:
        rounds.append(nodes)
        up = stored(_grouped(nodes, len(rounds) - 1).groupBy("grp").applyInPandas(_reduced, NODES), "merkle-tops")
        ended.append(up.filter("n = 1").select("tree", "start", "node"))
        nodes = up.filter("n > 1")
        if not nodes.limit(1).count():
            return rounds, ended


def descend(rounds: list[DataFrame], outer: list[DataFrame], finish, schema: str) -> DataFrame:
    """Every round's members cogrouped with the outer nodes of their superblocks, from the top round down.

    ``outer`` holds, by round, the outer nodes of the trees that end in it.
    """
    below = None
    for level in reversed(range(len(rounds))):
        needed = outer[level] if below is None else outer[level].unionByName(below)
        sides = _grouped(rounds[level], level).groupBy("grp"), needed.withColumn("grp", _group(F.col("block"), level)).groupBy("grp")
        if level:
            below = stored(sides[0].cogroup(sides[1]).applyInPandas(_placed, OUTER), "merkle-outer")
        else:
            below = sides[0].cogroup(sides[1]).applyInPandas(finish, schema)
    return below


def _before(counts: DataFrame, by: str, what: str) -> DataFrame:
    """(``by``, before): the sum of ``what`` in the partitions before, for a table of one row per shuffle partition."""
    w = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(by, F.coalesce(F.sum(what).over(w), F.lit(0)).alias("before"))


def ordered(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, sources) of ``leaves`` (doc_id, source, node, tampered): the leaves with their tree, its start and their rank in it."""
    order = ["source", "doc_id", "node", "salt"]
    salted = leaves.withColumn("salt", F.monotonically_increasing_id())
    lined = salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt").withColumn("at", F.monotonically_increasing_id())
    lined = stored(
        lined.withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}), "merkle-leaves"
    )
    runs = stored(lined.groupBy("part", "source").agg(F.min("at").alias("lo"), F.count("*").alias("c")), "merkle-runs")
    offsets = F.broadcast(stored(_before(runs.groupBy("part").agg(F.sum("c").alias("c")), "part", "c"), "merkle-offsets"))
    first = F.min(F.struct((F.col("before") + F.col("lo")).alias("start"), "part")).alias("first")
    sources = runs.join(offsets, "part").groupBy("source").agg(first, F.sum("c").alias("n")).select("source", "n", "first.*")
    sources = stored(sources, "merkle-sources")
    earlier = F.broadcast(stored(_before(sources.groupBy("part").agg(F.count("*").alias("c")), "part", "c"), "merkle-earlier"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("start")) - 1
    trees = stored(
        sources.join(earlier, "part").select(F.col("source").alias("of"), "n", "start", (F.col("before") + within).alias("tree")), "merkle-trees"
    )
    members = (
        lined.join(offsets, "part")
        .join(trees, F.col("source").eqNullSafe(F.col("of")))
        .select("tree", "start", (F.col("before") + F.col("at") - F.col("start")).alias("rank"), "n", "node", "doc_id", "tampered")
    )
    return members, trees


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``."""
    ship_package(docs.sparkSession)
    values = {c: F.col(f"`{c}`").cast("string") for c in COLUMNS}
    altered = {**values, "text": F.translate(values["text"], _UPPER, _LOWER)}
    tamper = F.crc32(values["doc_id"].cast("binary")) % TAMPER_EVERY == 0
    leaves = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            values["source"].alias("source"),
            leaf_digest(*values.values()).alias("node"),
            F.when(tamper, leaf_digest(*altered.values())).alias("tampered"),
        ),
        "merkle-rows",
    )
    members, trees = ordered(leaves)
    rounds, ended = rise(members)
    # The subroots are one tree more; the rank of one in it is the number of its source's tree.
    zero, n = F.lit(0).cast("long"), F.lit(trees.count()).cast("long")
    over = _all(ended).select(zero.alias("tree"), zero.alias("start"), F.col("tree").alias("rank"), n.alias("n"), "node")
    top_rounds, top_ended = rise(stored(over, "merkle-top"))
    none = F.array().cast("array<string>")
    roots = [
        e.select("tree", "start", zero.alias("block"), none.alias("before"), none.alias("after"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
        for e in top_ended
    ]
    ways = stored(descend(top_rounds, roots, _placed, OUTER), "merkle-ways").select(F.col("block").alias("way"), "before", "after", "root")
    outer = [
        e.join(ways, F.col("tree") == F.col("way")).select("tree", "start", zero.alias("block"), "before", "after", F.col("node").alias("subroot"), "root")
        for e in ended
    ]
    return descend(rounds, outer, _folded, FOLDED)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_PARTS = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c} END" for c in ("doc_id", "source", "lang", "n_chars")
)
ORACLE = f"""
    WITH RECURSIVE d AS (
        SELECT row_number() OVER () AS row_no, doc_id, source, sha256({_PARTS} || {{text}}) AS leaf,
               CASE WHEN crc % {TAMPER_EVERY} = 0 THEN sha256({_PARTS} || {{lower}}) ELSE sha256({_PARTS} || {{text}}) END AS other
        FROM (SELECT *, translate(text, '{_UPPER}', '{_LOWER}') AS low,
                     xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                         lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))),
                         4294967295::BIGINT) AS crc
              FROM documents)),
    place AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                     row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
                     count(*) OVER (PARTITION BY source) AS n FROM d),
    low(level, tree, rank, n, node) AS (
        SELECT 0, tree, rank, n, leaf FROM place
        UNION ALL SELECT max(level) + 1, tree, rank // {RUN}, (max(n) + {RUN - 1}) // {RUN}, sha256(string_agg(node, '' ORDER BY rank))
        FROM low WHERE n > 1 GROUP BY tree, rank // {RUN}),
    sub AS (SELECT tree, node AS subroot, level AS depth FROM low WHERE n = 1),
    high(level, rank, n, node) AS (
        SELECT 0, tree, (SELECT count(*) FROM sub), subroot FROM sub
        UNION ALL SELECT max(level) + 1, rank // {RUN}, (max(n) + {RUN - 1}) // {RUN}, sha256(string_agg(node, '' ORDER BY rank))
        FROM high WHERE n > 1 GROUP BY rank // {RUN}),
    up(row_no, level, tree, rank, depth) AS (
        SELECT row_no, 0, tree, rank, depth FROM place JOIN sub USING (tree)
        UNION ALL SELECT row_no, level + 1, tree, CASE WHEN level + 1 = depth THEN tree ELSE rank // {RUN} END, depth
        FROM up WHERE level + 1 < depth + (SELECT max(level) FROM high)),
    fixed AS (SELECT row_no, level, depth, CASE WHEN level = depth THEN tree ELSE rank END AS rank, tree FROM up),
    kin AS (
        SELECT f.row_no, f.level, o.rank AS other, f.rank, o.node FROM fixed f JOIN low o
            ON f.level < f.depth AND o.level = f.level AND o.tree = f.tree AND o.rank // {RUN} = f.rank // {RUN}
        UNION ALL SELECT f.row_no, f.level, o.rank, f.rank, o.node FROM fixed f JOIN high o
            ON f.level >= f.depth AND o.level = f.level - f.depth AND o.rank // {RUN} = f.rank // {RUN}),
    step AS (
        SELECT row_no, level, coalesce(string_agg(node, '' ORDER BY other) FILTER (other < rank), '') AS before,
               coalesce(string_agg(node, '' ORDER BY other) FILTER (other > rank), '') AS after
        FROM kin WHERE level < (SELECT max(level) FROM high) + (SELECT max(depth) FROM sub) GROUP BY row_no, level),
    fold(row_no, level, node) AS (
        SELECT row_no, 0, other FROM d
        UNION ALL SELECT f.row_no, f.level + 1, sha256(before || node || after) FROM fold f JOIN step s ON s.row_no = f.row_no AND s.level = f.level),
    folded AS (SELECT row_no, arg_max(node, level) AS folded_root FROM fold GROUP BY row_no),
    proof AS (SELECT row_no, sha256(string_agg(before || after, '' ORDER BY level)) AS proof_sha256 FROM step GROUP BY row_no),
    top AS (SELECT node AS root FROM high WHERE n = 1)
    SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM place JOIN sub USING (tree) JOIN folded USING (row_no) LEFT JOIN proof USING (row_no) CROSS JOIN top
""".format(
    text=" || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END".removeprefix(" || "),
    lower="CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(low)) || ':' || low END",
)
