"""Merkle manifest of a table: a persistent tree of which every changed row makes a version of its own.

Rows are leaves. In each group, in order, every three consecutive nodes become their hash, until one is left; so do the
groups' last nodes. The tree is cut into aligned blocks of 3^7 leaves: a task builds one block from the digests alone,
and the blocks' tops are the leaves of the next, smaller table. A changed row's version copies the ancestors of its leaf
inside its block, then goes on along the nodes that the blocks above have handed down, and shares every other node with
the tree it came from. Texts are hashed where they lie and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from prepkit.llm.shared import bounded, stored

#: Children of a node, levels of a block, rows a task hands on at once.
ARITY, HEIGHT, AT_ONCE = 3, 7, 2000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(values: Sequence[Column]) -> Column:
    """Binary SHA-256 of the values, each ``-`` if null, else its UTF-8 byte count, a colon, and it as text."""
    texts = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]).cast("binary"), 256))


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, id, digest and others) with ``place``, from 0 by id, and ``n`` in each group, nulls first.

    Sorted by ranges of all groups together, so a group may hold any share of the rows. Rows of one id stand by digest;
    equal ones are told apart by where they were read.
    """
    kept = stored(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    order = ["grp", "id", "digest", "tie"]
    ranged = kept.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    # the number's high bits tell the range, so it rises through all of them
    ranged = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "merkle-order").withColumn("range", F.shiftright("at", 33))
    sizes = ranged.groupBy("grp", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(sizes.select(
        F.col("grp").alias("of"), F.col("range").alias("in"), "first", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
        F.sum("size").over(group).alias("n"),
    ), "merkle-starts")
    both = ranged.join(bounded(starts, "of"), ranged["grp"].eqNullSafe(F.col("of")) & (F.col("range") == F.col("in")))
    return both.withColumn("place", F.col("before") + F.col("at") - F.col("first")).select(*rows.columns, "place", "n")


def _levels(nodes: list[str], n: int, height: int) -> list[list[str]]:
    """The nodes of a block, leaves first: all its levels if the group goes beyond the block, else up to its one top."""
    out = [nodes]
    while len(out) <= height if n > ARITY**height else len(out[-1]) > 1:
        low = out[-1]
        out.append([sha256("".join(low[i:i + ARITY]).encode()).hexdigest() for i in range(0, len(low), ARITY)])
    return out


def _beside(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    """What stands left and right of each node from a leaf up to the block's top."""
    out = []
    for nodes in levels[:-1]:
        first = place - place % ARITY
        out.append(("".join(nodes[first:place]), "".join(nodes[place + 1:first + ARITY])))
        place //= ARITY
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each block in turn, from batches sorted by (grp, block); the block is known by the first two columns."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if held and held[0][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _tops(height: int):
    """(grp, block, place, n, digest) to a row for each block."""
    def emit(rows):
        grp, place, n, top = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(grp, pa.string()), pa.array(place, pa.int64()), pa.array(n, pa.int64()), pa.array(top, pa.binary())],
            ["grp", "place", "n", "digest"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in _blocks(batches):
            grp, block, _, n, _ = rows[0]
            top = _levels([r[4].hex() for r in rows], n, height)[-1][0]
            out.append((grp, block, -(-n // ARITY**height), bytes.fromhex(top)))
            if len(out) >= AT_ONCE:
                yield emit(out)
                out = []
        if out:
            yield emit(out)

    return run


def _handed(height: int):
    """(grp, block, place, n, digest, path, root): after a row of place -1 with the block's path, a row for each node."""
    def emit(rows):
        grp, place, path, root = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(grp, pa.string()), pa.array(place, pa.int64()), pa.array(path, pa.string()), pa.array(root, pa.binary())],
            ["grp", "place", "path", "root"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in _blocks(batches):
            (*_, above, root), *nodes = rows
            levels = _levels([r[4].hex() for r in nodes], nodes[0][3], height)
            for k, r in enumerate(nodes):
                path = "|".join(f"{left},{right}" for left, right in _beside(levels, k))
                out.append((r[0], r[2], "|".join(filter(None, (path, above))), root))
                if len(out) >= AT_ONCE:
                    yield emit(out)
                    out = []
        if out:
            yield emit(out)

    return run


def _versions(kind: pa.DataType, height: int):
    """(grp, block, place, n, digest, path, root, subroot, id, changed) to a row for each leaf, with its version's path."""
    hashes = pa.list_(pa.binary())

    def emit(rows):
        kinds = (pa.string(), pa.int64(), kind, pa.binary(), pa.binary(), pa.binary(), hashes, hashes)
        names = ["grp", "place", "id", "leaf", "subroot", "root", "proof", "version"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in _blocks(batches):
            top, *leaves = rows
            above, root, subroot = top[5:8]
            above = [tuple(x.split(",")) for x in above.split("|")] if above else []
            levels = _levels([r[4].hex() for r in leaves], leaves[0][3], height)
            for k, r in enumerate(leaves):
                node = (r[9] if r[9] is not None else r[4]).hex()
                proof, version = [], [node]
                for left, right in _beside(levels, k) + above:
                    proof.append(left + right)
                    node = sha256((left + node + right).encode()).hexdigest()
                    version.append(node)
                siblings = bytes.fromhex("".join(proof))
                out.append((
                    r[0], r[2], r[8], r[4], subroot, root, [siblings[i:i + 32] for i in range(0, len(siblings), 32)],
                    [bytes.fromhex(x) for x in version],
                ))
                if len(out) >= AT_ONCE:
                    yield emit(out)
                    out = []
        if out:
            yield emit(out)

    return run


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")


def _block(height: int) -> Column:
    return F.floor(F.col("place") / ARITY**height).alias("block")


def _above(nodes: DataFrame, height: int) -> DataFrame:
    """(grp, place, path, root) for each block of ``nodes`` (grp, place, n, digest): the way from its top to the group's."""
    tops = stored(
        _in_blocks(nodes.select("grp", _block(height), "place", "n", "digest")).mapInArrow(_tops(height), "grp string, place long, n long, digest binary"),
        "merkle-tops",
    )
    done = tops.where("n = 1").select("grp", "place", F.lit("").alias("path"), F.col("digest").alias("root"))
    more = tops.where("n > 1")
    if more.isEmpty():
        return done
    return done.unionByName(stored(_paths(more, height), "merkle-paths"))


def _paths(nodes: DataFrame, height: int) -> DataFrame:
    """(grp, place, path, root) for each of ``nodes`` (grp, place, n, digest)."""
    heads = _above(nodes, height).select(
        "grp", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("binary").alias("digest"), "path", "root",
    )
    rows = nodes.select(
        "grp", _block(height), "place", "n", "digest", F.lit(None).cast("string").alias("path"), F.lit(None).cast("binary").alias("root")
    )
    return _in_blocks(rows.unionByName(heads)).mapInArrow(_handed(height), "grp string, place long, path string, root binary")


def versions(docs: DataFrame, changes: dict[str, Column] | None = None, where: Column | None = None, columns: Sequence[str] = COLUMNS,
             group_col: str = "source", id_col: str = "doc_id", height: int = HEIGHT) -> DataFrame:
    """(grp, place, id, leaf, subroot, root, proof, version) for each row of ``docs``; all digests are binary.

    ``leaf`` is the digest of ``columns``; ``place`` counts by id in the row's group; ``proof`` holds the siblings from
    the leaf's level up to the root, left to right. ``version`` is the leaf and each ancestor as they are once ``changes``
    (new values by column) are made to this row alone, if ``where`` holds for it; the last is that version's root. It
    and the siblings are all nodes on which a version and the tree can differ; the tree of an unchanged row is ``root``'s.

    A null group, id or value counts as one, and comes first; rows of one id stand by digest, and equal rows are a leaf
    each. A group of one row is its own subroot, a table of one group has the subroot as root. An empty table has no
    rows. Other columns are not read.
    """
    at = {c: F.col(f"`{c}`") for c in columns}
    changed = F.lit(None).cast("binary")
    if changes:
        changed = F.when(F.lit(True) if where is None else where, digest([changes.get(c, v) for c, v in at.items()]))
    own = docs.select(
        F.col(f"`{group_col}`").cast("string").alias("grp"), F.col(f"`{id_col}`").alias("id"), digest(list(at.values())).alias("digest"),
        changed.alias("changed"),
    )
    leaves = placed(own)
    inner = stored(_above(leaves.select("grp", "place", "n", "digest"), height), "merkle-inner")
    groups = placed(inner.where("place = 0").select(F.lit("").alias("grp"), F.col("grp").alias("id"), F.col("root").alias("digest")))
    outer = _paths(groups.select("grp", "place", "n", "digest"), height)
    roots = stored(groups.join(outer, "place").select(F.col("id").alias("of"), F.col("path").alias("beyond"), outer["root"].alias("whole")), "merkle-roots")
    heads = inner.join(bounded(roots, "of", "beyond"), inner["grp"].eqNullSafe(F.col("of"))).select(
        "grp", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("binary").alias("digest"), F.concat_ws("|", F.nullif("path", F.lit("")), F.nullif("beyond", F.lit(""))).alias("path"),
        F.col("whole").alias("root"), F.col("root").alias("subroot"), F.lit(None).cast(own.schema["id"].dataType).alias("id"),
        F.lit(None).cast("binary").alias("changed"),
    )
    none = F.lit(None).cast("binary")
    rows = leaves.select(
        "grp", _block(height), "place", "n", "digest", F.lit(None).cast("string").alias("path"), none.alias("root"), none.alias("subroot"), "id", "changed"
    )
    kind = own.schema["id"].dataType
    out = f"grp string, place long, id {kind.simpleString()}, leaf binary, subroot binary, root binary, proof array<binary>, version array<binary>"
    return _in_blocks(rows.unionByName(heads)).mapInArrow(_versions(to_arrow_type(kind), height), out)


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def tampered_digests(docs: DataFrame) -> DataFrame:
    """The proofs of all documents, and whether each still verifies once the line breaks of every other text are gone."""
    own = F.col("doc_id")
    even = F.crc32(own.cast("string").cast("binary")) % 2 == 0
    found = versions(docs, {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}, even)
    folded = F.element_at("version", -1)
    return found.select(
        F.col("id").alias("doc_id"), *[_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(F.array_join(F.transform("proof", _hex), "").cast("binary"), 256).alias("proof_sha256"),
        _hex(folded).alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )


def _encoded(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_encoded, ("doc_id", "source", "lang", "n_chars", text))) + ")"


SQL = f"""
WITH RECURSIVE
steps AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b], range(1, 9)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c
    FROM range(256) r(b))),
leaves AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf, {_leaf("replace(text, chr(10), '')")} AS bent,
         xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(doc_id::VARCHAR) + 1),
                                                                  lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
                         lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 2 = 0 AS even
  FROM documents, steps),
standing AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
inner_tree AS (
  SELECT source, 0 AS depth, list(leaf ORDER BY place) AS nodes FROM standing GROUP BY source
  UNION ALL
  SELECT source, depth + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3*i+1:3*i+3], '')))
  FROM inner_tree WHERE len(nodes) > 1),
subroots AS (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM inner_tree WHERE len(nodes) = 1),
outer_tree AS (
  SELECT 0 AS depth, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL
  SELECT depth + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3*i+1:3*i+3], '')))
  FROM outer_tree WHERE len(nodes) > 1),
inner_walk AS (
  SELECT doc_id, source, leaf, 0 AS depth, place, '' AS proof, CASE WHEN even THEN bent ELSE leaf END AS folded FROM standing
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf, w.depth + 1, w.place // 3,
         w.proof || array_to_string(n.nodes[w.place - w.place % 3 + 1:w.place], '')
                 || array_to_string(n.nodes[w.place + 2:w.place - w.place % 3 + 3], ''),
         sha256(array_to_string(n.nodes[w.place - w.place % 3 + 1:w.place], '') || w.folded
                || array_to_string(n.nodes[w.place + 2:w.place - w.place % 3 + 3], ''))
  FROM inner_walk w JOIN inner_tree n ON n.source IS NOT DISTINCT FROM w.source AND n.depth = w.depth
  WHERE len(n.nodes) > 1),
joined AS (
  SELECT w.doc_id, w.leaf, s.subroot, s.place, w.proof, w.folded
  FROM inner_walk w
  JOIN (SELECT source, max(depth) AS depth FROM inner_tree GROUP BY source) d
    ON d.source IS NOT DISTINCT FROM w.source AND d.depth = w.depth
  JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source),
outer_walk AS (
  SELECT doc_id, leaf, subroot, 0 AS depth, place, proof, folded FROM joined
  UNION ALL
  SELECT w.doc_id, w.leaf, w.subroot, w.depth + 1, w.place // 3,
         w.proof || array_to_string(n.nodes[w.place - w.place % 3 + 1:w.place], '')
                 || array_to_string(n.nodes[w.place + 2:w.place - w.place % 3 + 3], ''),
         sha256(array_to_string(n.nodes[w.place - w.place % 3 + 1:w.place], '') || w.folded
                || array_to_string(n.nodes[w.place + 2:w.place - w.place % 3 + 3], ''))
  FROM outer_walk w JOIN outer_tree n ON n.depth = w.depth
  WHERE len(n.nodes) > 1)
SELECT w.doc_id, w.leaf, w.subroot, n.nodes[1] AS root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root,
       w.folded = n.nodes[1] AS verified
FROM outer_walk w JOIN outer_tree n ON n.depth = w.depth AND len(n.nodes) = 1
"""
