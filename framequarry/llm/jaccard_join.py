"""Op 7: join of texts whose word shingle sets have a Jaccard similarity of at least a threshold.

Texts with one set are one node. Two sets above the threshold share many of the tokens that their beginnings hold in a
common order; a first round, in the order of the hashes, drops the nodes whose beginning has too few tokens in common
with any others. Among the nodes that are left all tokens are counted, and the rarest come first in the order of the
second round: two sets above the threshold share a token of their prefixes (the first `n - ceil(t * n) + 1` tokens), and
a token that stands late in both leaves too few behind it. A node whose prefix holds only tokens of its own has no links.

Nodes with a prefix token in common meet in tiles of one token and two neighbouring size bands; inside a tile places,
sizes and the bit counts of parity bitmaps bound the overlap from above, and what remains is decided by intersecting
the sorted sets.

A large group of near copies is not expanded into its pairs: each node is first compared with the node that leads most
of its tokens, then in each tile with its nearest nodes of other components, and last with all nodes it is not yet
connected with. Every pair that could connect two components is compared, so the components are those of all links.
`jaccard_links` counts the links as well; it compares all candidates of every tile.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .components import components
from .registry import batch, map_batches, query, read, renamed
from .slots import in_table, slot_table
from .words import LOWERED, sequence_hash, texts, windows, words

#: The first round looks at so many tokens in a hundred more than a prefix holds, and asks for as many in common.
EXTRA = 8
#: Tokens of more nodes than this are equally frequent in the order of the second round.
MOST_COUNTED = 4096
#: Nodes of one tile that are compared in one piece; larger tiles are cut into blocks, and all pairs of blocks compared.
TILE_NODES = 1024
#: Pairs that a task holds before it passes them on.
PAIRS_HELD = 100_000
#: Candidates a node proposes per tile before all that are left are compared.
NEAREST = 2
_NO_TOKENS = np.empty(0, np.uint64)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted set of each text: hashes of its runs of `k` words, or of the whole sequence if it is shorter."""
    for chunk in texts(column):
        found = words(chunk, LOWERED)
        first, hashes = windows(found, k)
        cuts = np.searchsorted(first, found.bounds)
        for i in range(chunk.n):
            if cuts[i + 1] > cuts[i]:
                yield np.unique(hashes[cuts[i] : cuts[i + 1]])
            elif found.bounds[i + 1] > found.bounds[i]:
                yield np.array([sequence_hash(found.hash[found.bounds[i] : found.bounds[i + 1]])], np.uint64)
            else:
                yield _NO_TOKENS


def signature(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def _least(n, percent: int):
    """`ceil(percent * n / 100)`."""
    return -(-n * percent // 100)


def beginning(tokens: np.ndarray, percent: int) -> np.ndarray:
    """48 bits of each token the first round looks at: of two linked sets, both beginnings hold the asked number of common tokens.

    All but `n - ceil(t * n) + c` tokens of a set follow its beginning. Say the beginning of x ends before that of y:
    then of the common tokens, at least `ceil(t * n)` (n tokens are in x), at most `ceil(t * n) - c` follow it, and the
    others stand in both. c grows with n, so it is at least that of the smallest set that can be linked.
    """
    n = len(tokens)
    return tokens[: n - _least(n, percent) + _least(n, min(EXTRA, percent))] >> np.uint64(16)


def parity_bits(tokens: np.ndarray) -> bytes:
    """Bit i: whether an odd number of tokens falls on i. Two sets differ in at least as many tokens as bitmaps in bits."""
    width = min(max(64, 1 << int(len(tokens)).bit_length()), 8192)
    odd = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """The bitmap of `size` bytes for the same set: bit positions are taken modulo the width."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, size // 8), axis=0)


def can_link(n_a, n_b, differing, percent: int):
    """Whether sets of these sizes that differ in at least `differing` tokens can reach the threshold."""
    return (100 + percent) * (n_a + n_b - differing) >= 2 * percent * (n_a + n_b)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal values in the first column; the input is sorted by it."""
    kept: list[pa.RecordBatch] = []
    for part in batches:
        if not part.num_rows:
            continue
        keys = part.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if kept and (cut or keys[0] != kept[-1].column(0)[0].as_py()):
            first = kept[-1].column(0)[0].as_py()
            same = int(np.searchsorted(keys, first, "right"))
            yield pa.Table.from_batches([*kept, part.slice(0, same)])
            kept = []
            if same < cut:
                yield pa.Table.from_batches([part.slice(same, cut - same)])
            cut = max(cut, same)
        elif cut:
            yield pa.Table.from_batches([part.slice(0, cut)])
        if cut < part.num_rows:
            kept.append(part.slice(cut))
    if kept:
        yield pa.Table.from_batches(kept)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (token, node) sorted by token: how many tokens of each node others have too, some at a time."""
    schema = "node long, hits long"
    last_token, last_node, told = None, None, True
    for part in batches:
        if not part.num_rows:
            continue
        token, node = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        follows = np.concatenate([[token[0] == last_token], token[1:] == token[:-1]])
        leads = np.append(follows[1:], False)
        keep = node[follows | leads]
        if follows[0] and not told:
            keep = np.append(keep, last_node)
        found, hits = np.unique(keep, return_counts=True)
        if len(found):
            yield batch(schema, found, hits)
        last_token, last_node, told = int(token[-1]), int(node[-1]), bool(follows[-1])


_COUNTED = "node long, n long, token long, df long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (token, node, n) sorted by token: the rows of tokens of several nodes, with their number, MOST_COUNTED at most.

    The rows of a token are held until its number is known or has reached that bound.
    """
    token = np.empty(0, np.int64)
    node = n = token
    reached = None  # a token whose first MOST_COUNTED rows are out

    def ready(size: int) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], token[1:size] != token[: size - 1]]))
        df = np.repeat(np.diff(np.append(starts, size)), np.diff(np.append(starts, size)))
        df[token[:size] == reached] = MOST_COUNTED
        keep = df > 1
        if keep.any():
            yield batch(_COUNTED, node[:size][keep], n[:size][keep], token[:size][keep], np.minimum(df[keep], MOST_COUNTED))

    for part in batches:
        if not part.num_rows:
            continue
        token, node, n = (np.concatenate([old, part.column(i).to_numpy(zero_copy_only=False)]) for i, old in enumerate((token, node, n)))
        size = int(np.searchsorted(token, token[-1], "left"))
        if len(token) - size >= MOST_COUNTED or token[-1] == reached:
            late, size = int(token[-1]), len(token)
        else:
            late = None
        if size:
            yield from ready(size)
        reached = late if late is not None else reached
        token, node, n = token[size:], node[size:], n[size:]
    if len(token):
        yield from ready(len(token))


_PREFIX = "token long, node long, n long, pos long"


def _prefixes(percent: int):
    """Of rows as `_counted` gives them, sorted by node: the tokens of each node's prefix that others have too, and their places."""

    def run(batches):
        for table in _runs(batches):
            node, n, token, df = (table.column(c).to_numpy() for c in ("node", "n", "token", "df"))
            order = np.lexsort((token, df, node))
            node, n, token = node[order], n[order], token[order]
            starts = np.flatnonzero(np.diff(node, prepend=node[0] - 1))
            shared = np.diff(np.append(starts, len(node)))
            first = n[starts] - shared  # tokens of this node alone come first
            pos = np.arange(len(node)) - np.repeat(starts - first, shared)
            keep = pos < n - _least(n, percent) + 1
            if keep.any():
                yield batch(_PREFIX, token[keep], node[keep], n[keep], pos[keep])

    return run


_MET = "token long, node long, n long, pos long, hub long"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of prefix tokens sorted by (token, node): the same with the token's smallest node."""
    last_token, hub = None, None
    for part in batches:
        if not part.num_rows:
            continue
        token, node, n, pos = (part.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        new = np.concatenate([[token[0] != last_token], token[1:] != token[:-1]])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(token)), -1))
        hubs = np.where(lead < 0, hub if hub is not None else 0, node[np.maximum(lead, 0)])
        yield batch(_MET, token, node, n, pos, hubs)
        last_token, hub = int(token[-1]), int(hubs[-1])


def _tile_pairs(percent: int, nearest: int | None, every: bool = False):
    """Of rows sorted by tile: pairs of unconnected nodes, or of all, whose sizes and bit counts leave the threshold possible."""

    def run(batches):
        for table in _runs(batches):
            tile = table.column("tile").to_numpy()
            cuts = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist(), len(tile)]
            node, part, n, pos, own, block, cross = (table.column(c).to_numpy() for c in ("node", "component", "n", "pos", "own", "block", "cross"))
            bits = table.column("bits").to_pylist()
            left, right, size = [], [], 0
            for lo, hi in zip(cuts, cuts[1:]):
                if hi - lo < 2 or not every and (part[lo:hi] == part[lo]).all():
                    continue
                width = min(len(x) for x in bits[lo:hi])
                maps = np.stack([folded(x, width) for x in bits[lo:hi]])
                for i in range(lo, hi - 1):
                    rest = slice(i + 1, hi)
                    ok = (every | (part[rest] != part[i])) & (own[rest] | own[i]) & (node[rest] != node[i])
                    if cross[i]:
                        ok &= block[rest] != block[i]
                    ok &= can_link(n[rest], n[i], np.abs(n[rest] - n[i]), percent)
                    # What the first common token of two sets leaves in the shorter rest bounds their overlap.
                    ok &= (100 + percent) * np.minimum(n[rest] - pos[rest], n[i] - pos[i]) >= percent * (n[rest] + n[i])
                    at = np.flatnonzero(ok)
                    if not len(at):
                        continue
                    apart = np.bitwise_count(maps[i - lo + 1 + at] ^ maps[i - lo]).sum(axis=1, dtype=np.int64)
                    ok = can_link(n[rest][at], n[i], apart, percent)
                    at, apart = at[ok], apart[ok]
                    if nearest and len(at) > nearest:
                        at = at[np.argpartition(apart / (n[rest][at] + n[i]), nearest)[:nearest]]
                    other = node[rest][at]
                    left.append(np.minimum(other, node[i]))
                    right.append(np.maximum(other, node[i]))
                    size += len(at)
                    if size >= PAIRS_HELD:
                        yield batch("a long, b long", np.concatenate(left), np.concatenate(right))
                        left, right, size = [], [], 0
            if left:
                yield batch("a long, b long", np.concatenate(left), np.concatenate(right))

    return run


def _bounded(percent: int):
    def run(part):
        n_a, n_b = (part.column(c).to_numpy() for c in ("n_a", "n_b"))
        apart = []
        for a, b in zip(part.column("bits_a").to_pylist(), part.column("bits_b").to_pylist()):
            size = min(len(a), len(b))
            apart.append(int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum()))
        ok = can_link(n_a, n_b, np.maximum(np.array(apart), np.abs(n_a - n_b)), percent)
        yield batch("a long, b long", part.column("a").to_numpy()[ok], part.column("b").to_numpy()[ok])

    return run


def _linked(percent: int):
    def run(part):
        a, b = part.column("set_a").to_pylist(), part.column("set_b").to_pylist()
        ok = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * common >= percent * (len(x) + len(y) - common))
        ok = np.array(ok, bool)
        yield batch("a long, b long", part.column("a").to_numpy()[ok], part.column("b").to_numpy()[ok])

    return run


def jaccard_components(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of `df`: doc_id, n_shingles (size of its set), component_id (smallest doc_id linked to it, directly or not).

    Two texts are linked when `100 * intersection >= percent * union`. A null or blank text has an empty set, is linked
    with nothing and is its own component. Rows with a null doc_id take part like others: their component_id is the
    smallest doc_id that is linked to them, null if there is none. Repeated rows stay, each with the same values; rows
    with one doc_id and different texts are judged by their texts. Sets are compared by 64-bit hashes of the shingles.
    Extra columns are not read. An empty table gives an empty result.
    """
    return _joined(df, id_column, text_column, k, percent, False)


def jaccard_links(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """The rows of `jaccard_components` with n_links, the number of other rows that each is linked to, copies included.

    Every candidate pair of different sets is compared, which grows with the square of a group of near copies.
    """
    return _joined(df, id_column, text_column, k, percent, True)


def _joined(df: DataFrame, id_column: str, text_column: str, k: int, percent: int, every: bool) -> DataFrame:
    docs = renamed(df, doc_id=id_column, text=text_column).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("which"))
    sketched = "doc_id long, which long, n long, sig binary, beginning binary"

    def sketch(part):
        for sets, rows in _chunks(part):
            packed = [beginning(s, percent).astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in sets]
            yield batch(sketched, rows.column("doc_id"), rows.column("which"), [len(s) for s in sets], [signature(s) for s in sets], packed)

    def member(part):
        for sets, rows in _chunks(part):
            yield batch("doc_id long, n_shingles long, sig binary", rows.column("doc_id"), [len(s) for s in sets], [signature(s) for s in sets])

    def _chunks(part):
        """The sets of some rows at a time."""
        sets, first = [], 0
        for tokens in shingle_sets(part.column("text"), k):
            sets.append(tokens)
            if len(sets) == 512 or first + len(sets) == part.num_rows:
                yield sets, part.slice(first, len(sets))
                first, sets = first + len(sets), []

    nodes = stage(
        map_batches(docs, sketch, sketched).where("sig is not null")
        .groupBy("sig").agg(
            F.min("doc_id").alias("label"), F.min(F.struct(F.coalesce("doc_id", F.lit(0)).alias("key"), "which")).alias("place"),
            F.count("*").alias("copies"), F.first("n").alias("n"), F.first("beginning").alias("beginning"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )

    def begin(part):
        packed, at = part.column("beginning").to_pylist(), part.column("node").to_numpy()
        wide = np.zeros((sum(map(len, packed)) // 6, 8), np.uint8)
        wide[:, :6] = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 6)
        yield batch("token long, node long", wide.reshape(-1).view(np.int64), np.repeat(at, [len(x) // 6 for x in packed]))

    first_round = map_batches(nodes.select("node", "beginning"), begin, "token long, node long").repartition("token").sortWithinPartitions("token")
    hits = first_round.mapInArrow(_repeated, "node long, hits long").groupBy("node").agg(F.sum("hits").alias("hits"))
    extra = min(EXTRA, percent)
    asked = F.ceil(F.ceil(F.col("n") * percent / 100) * extra / 100)
    wanted = stage(hits.join(nodes.select("node", "n", "place"), "node").where(F.col("hits") >= asked).select("node", "place.*"), "wanted")
    table = slot_table(wanted, F.xxhash64("key", "which"))

    def pick(part):
        ok = pa.array(in_table(table, part.column("slot").to_numpy()))
        yield batch("key long, which long, text string", *(part.column(c).filter(ok) for c in ("key", "which", "text")))

    kept = "node long, n long, tokens binary, bits binary"

    def whole(part):
        for found, rows in _chunks(part):
            yield batch(kept, rows.column("node"), [len(t) for t in found], [t.tobytes() for t in found], [parity_bits(t) for t in found])

    # The sets of the nodes that are left, from the text of a document of each; a bit table lets few other texts through.
    keyed = docs.select(F.coalesce("doc_id", F.lit(0)).alias("key"), "which", "text").withColumn("slot", F.xxhash64("key", "which"))
    few = map_batches(keyed, pick, "key long, which long, text string").join(wanted, ["key", "which"])
    sets = stage(map_batches(few.groupBy("key", "which", "node").agg(F.first("text").alias("text")), whole, kept), "sets")
    light = sets.select("node", "n", "bits")

    def every_token(part):
        held = part.column("tokens").to_pylist()
        sizes = [len(x) // 8 for x in held]
        yield batch("token long, node long, n long", np.frombuffer(b"".join(held), np.int64), np.repeat(part.column("node").to_numpy(), sizes), np.repeat(sizes, sizes))

    second_round = map_batches(sets.select("node", "tokens"), every_token, "token long, node long, n long").repartition("token").sortWithinPartitions("token")
    prefixes = second_round.mapInArrow(_counted, _COUNTED).repartition("node").sortWithinPartitions("node").mapInArrow(_prefixes(percent), _PREFIX)
    shared = stage(prefixes.repartition("token").sortWithinPartitions("token", "node").mapInArrow(_met, _MET), "shared")

    def linked(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("set_a"))
        right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("set_b"))
        return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b"), _linked(percent), "a long, b long")

    def bounded(pairs: DataFrame) -> DataFrame:
        ends = pairs.join(light.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b")), "b").join(
            light.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a")), "a")
        return map_batches(ends.select("a", "b", "n_a", "n_b", "bits_a", "bits_b"), _bounded(percent), "a long, b long")

    if every:
        parts = nodes.select("node", F.col("node").alias("component"))
    else:
        hubs = shared.where("node != hub").groupBy("node", "hub").agg(F.count("*").alias("common"))
        best = hubs.groupBy("node").agg(F.max(F.struct("common", F.negative("hub").alias("low"))).alias("best"))
        links = stage(linked(bounded(best.select(F.negative("best.low").alias("a"), F.col("node").alias("b")))), "links")
        parts = stage(components(links, "a", "b"), "parts")

    def tile_pairs(nearest: int | None) -> DataFrame:
        """Pairs of nodes of two components that share a token and can link by size and bits, or each node's nearest of them."""
        placed = shared.join(parts, "node", "left").select("token", "node", "n", "pos", F.coalesce("component", "node").alias("component"))
        between = (
            placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
            .where(F.lit(every) | (F.col("lo") < F.col("hi"))).select("token", "size")
        )
        band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / TILE_NODES)).cast("int")
        tiles = (
            placed.join(between, "token").join(light.select("node", "bits"), "node")
            .withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("own", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("band", band + F.when(F.col("own"), 0).otherwise(1))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                F.xxhash64("token", "band", F.least("block", "other"), F.greatest("block", "other")).alias("tile"), "node", "component", "n", "pos", "own",
                "block", (F.col("block") != F.col("other")).alias("cross"), "bits",
            )
        )
        return tiles.repartition("tile").sortWithinPartitions("tile", "node").mapInArrow(_tile_pairs(percent, nearest, every), "a long, b long").distinct()

    if every:
        links = stage(linked(tile_pairs(None)), "links")
        parts = stage(components(links, "a", "b"), "parts")
    else:
        # The nearest ones first: they connect most of a group of near copies, whose other pairs then need no look.
        for nearest in (NEAREST, None):
            more = stage(linked(tile_pairs(nearest)), "links")
            if not more.isEmpty():
                links = links.unionByName(more)
                parts = stage(components(links, "a", "b"), "parts")

    rooted = nodes.select("node", "sig", "label", "copies").join(parts, "node", "left").withColumn("root", F.coalesce("component", "node"))
    lowest = rooted.groupBy("root").agg(F.min("label").alias("lowest"))
    classes = rooted.join(lowest, "root").select("node", "sig", "lowest", "copies")
    if every:
        ends = links.select("a", "b").union(links.select("b", "a"))
        others = ends.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
        classes = classes.join(others.withColumnRenamed("a", "node"), "node", "left").withColumn("links", F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
    classes = stage(classes.drop("node", "copies", "others"), "classes")
    members = map_batches(docs, member, "doc_id long, n_shingles long, sig binary")
    return members.join(classes, "sig", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"),
        *([F.coalesce("links", F.lit(0)).alias("n_links")] if every else []),
    )


#: Links by counting common shingles of documents that share one; class representatives first, then all reachable.
COMPONENTS_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {documents}
), shingles AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words
), sets AS (SELECT min(doc_id) AS a, list_sort(s) AS s, len(s) AS n FROM shingles WHERE len(s) > 0 GROUP BY list_sort(s), len(s)
), tokens AS (SELECT a, n, unnest(s) AS t FROM sets
), common AS (SELECT x.a AS a, y.a AS b, x.n AS n, y.n AS m, count(*) AS c FROM tokens x JOIN tokens y ON x.t = y.t AND x.a < y.a GROUP BY ALL
), links AS (SELECT a, b FROM common WHERE 100 * c >= 75 * (n + m - c)
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (SELECT a, a AS r FROM sets UNION SELECT e.a, reach.r FROM reach JOIN edges e ON e.b = reach.a
), parts AS (SELECT a, min(r) AS component_id FROM reach GROUP BY a)
SELECT g.doc_id, CAST(len(g.s) AS BIGINT) AS n_shingles, CASE WHEN len(g.s) = 0 THEN g.doc_id ELSE parts.component_id END AS component_id
FROM shingles g LEFT JOIN sets ON sets.s = list_sort(g.s) LEFT JOIN parts USING (a)
"""


@query("op7_ngram_jaccard_join", COMPONENTS_SQL.format(documents="documents"))
def op7_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(read(spark, sf_dir, "documents"))
