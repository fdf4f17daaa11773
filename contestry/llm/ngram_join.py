"""Exact n-gram Jaccard join and its components.

The documents and their distinct 5-word shingles form a sparse incidence matrix; two documents link
where their rows' overlap reaches THRESHOLD of their union. Everything is a blocked product of that
matrix with itself, each step on what the size bounds of the one before leave:

1. Peeling. Blocks of rows send their shingles to blocks of columns (ranges of the shingle hash), which
   count the rows of every shingle and send the shared ones back. A row whose shared shingles are
   fewer than PERCENT of it can't link with anything and is dropped. Rows alike become one node, and
   the nodes are peeled once more, now ordered by their shingles' counts, rare ones first.
2. Of each node the first shared shingles, as many as a partner must share at least one of, are posted.
   Each posting list is compared with its most central node, its pivot.
3. The links found so far make components. In lists that still hold several of them, blocks of rows
   meet: bounds from sizes, shared sizes and positions tell which nodes may link across components,
   and only for those are whole rows brought to the block, where a sparse product accumulates the
   overlap counts of all pairs. Only links leave the block, one for two components.
4. Links merge by alternating large-star and small-star steps.

No pair is listed before its bounds hold, no link between components is lost, and long lists are dealt
to several blocks. No table of documents, links or components reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, small, unused, written
from .shingles import Sets, shingle_sets, slices

WORDS = 5
#: Overlap of at least PERCENT hundredths of the union.
PERCENT = 80
#: Shingles of a block of rows (one document at least), and of a block of columns (about).
ROW_BLOCK = 500_000
COLUMN_BLOCK = 1_000_000
#: Documents in a block of rows at most; the last 16-bit number marks a shingle of many of its rows.
BLOCK_DOCS, MANY = 30_000, 65_535
#: A shingle of more rows of one block than this goes to its block of columns once, with their number.
OFTEN = 4
#: Shingles of the rows that meet in a block of one posting list (about).
LIST_BLOCK = 2_000_000
#: Pairs whose bounds are computed at a time; bytes of rows in one group of blocks (about).
PAIRS, GROUP_BYTES = 300_000, 8 << 20
#: Most candidate rows whose keys a join may broadcast (16 bytes each).
KEYS = 1_000_000


def prefix_length(n, percent: int = PERCENT):
    """A partner shares at least one of this many first shingles: n less ceil(percent n / 100), and one."""
    return n - -(-percent * n // 100) + 1


def needed(a: F.Column, b: F.Column, percent: int = PERCENT) -> F.Column:
    """Least overlap of rows of a and b shingles: 100 o >= percent (a + b - o)."""
    return F.ceil((a + b) * percent / F.lit(100.0 + percent) - 1e-9)


def digests(sets: Sets) -> np.ndarray:
    """128 bits of every row, as two columns of 64."""
    data, at = memoryview(sets.tokens.view(np.uint8)), (sets.offsets * 8).tolist()
    found = b"".join(hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(at, at[1:]))
    return np.frombuffer(found, np.int64).reshape(-1, 2)


def binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def joined(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """The arrays in a binary column, one after the other, and their lengths; a null is empty."""
    values = [v or b"" for v in column.to_pylist()]
    return np.frombuffer(b"".join(values), kind), np.array([len(v) // np.dtype(kind).itemsize for v in values], np.int64)


def sizes_and_digests(docs: DataFrame, carry: list[str]) -> DataFrame:
    """carry's columns, the number n of a row's shingles, and its digest (d1, d2); n is 0 without words."""
    schema = T.StructType([*(docs.schema[c] for c in carry), *T._parse_datatype_string("n int, d1 long, d2 long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            for a, b in slices(text):
                sets = shingle_sets(text.slice(a, b - a))
                d = digests(sets)
                kept = [batch.column(batch.schema.get_field_index(c)).slice(a, b - a) for c in carry]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(sets.sizes, pa.int32()), pa.array(d[:, 0]), pa.array(d[:, 1])], [*carry, "n", "d1", "d2"])

    return docs.select(*carry, "text").mapInArrow(run, schema)


Rows = Callable[[pa.RecordBatch], Iterator[tuple[Sets, np.ndarray, np.ndarray]]]


def text_rows(batch: pa.RecordBatch) -> Iterator[tuple[Sets, np.ndarray, np.ndarray]]:
    """(rows, their numbers of shingles, their digests) of texts."""
    for a, b in slices(batch.column(0)):
        sets = shingle_sets(batch.column(0).slice(a, b - a))
        yield sets, sets.sizes, digests(sets)


def node_rows(batch: pa.RecordBatch) -> Iterator[tuple[Sets, np.ndarray, np.ndarray]]:
    """The same of nodes: columns n, id1, id2, tokens (sorted)."""
    tokens, sizes = joined(batch.column(3), np.uint64)
    ids = np.stack([batch.column(i).to_numpy() for i in (1, 2)], 1)
    yield Sets(tokens, np.concatenate([[0], np.cumsum(sizes)])), batch.column(0).to_numpy(), ids


SENT = "col int, base long, tok binary, idx binary, times binary, n binary, ids binary, many_tok binary, many_len binary, many_idx binary"
BACK = "base long, tok binary, idx binary, df binary, n binary, ids binary, many_tok binary, many_len binary, many_idx binary"
PEELED = "n int, id1 long, id2 long, tokens binary, centre double"


def row_blocks(rows: Rows, columns: int) -> Callable:
    """A function of Arrow batches -> SENT: each block of rows as pieces for the blocks of columns.

    base names the block. idx has a shingle's row in the block, or MANY where OFTEN rows of the block
    have it; those rows stay in the block's own piece (n, ids, many_...), which waits for the answers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, task = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for sets, n, ids in rows(batch):
                at = 0
                while at < len(n):
                    stop = int(np.searchsorted(sets.offsets, sets.offsets[at] + ROW_BLOCK, side="right")) - 1
                    stop = min(max(stop, at + 1), at + BLOCK_DOCS)
                    yield _sent(sets.part(at, stop), n[at:stop], ids[at:stop], task + made, columns)
                    made, at = made + 1, stop

    return run


def _sent(sets: Sets, n: np.ndarray, ids: np.ndarray, base: int, columns: int) -> pa.RecordBatch:
    tok, idx = sets.tokens, np.repeat(np.arange(len(n), dtype=np.uint16), sets.sizes)
    ordered = np.sort(tok)
    often = ordered[OFTEN:][ordered[OFTEN:] == ordered[:-OFTEN]] if len(ordered) > OFTEN else ordered[:0]
    many_tok, many_len, many_idx = np.unique(often), np.empty(0, np.int32), idx[:0]
    times = np.empty(0, np.int32)
    if len(many_tok):
        place = np.minimum(np.searchsorted(many_tok, tok), len(many_tok) - 1)
        has = many_tok[place] == tok
        order = np.argsort(place[has], kind="stable")
        many_idx, many_len = idx[has][order], np.bincount(place[has], minlength=len(many_tok)).astype(np.int32)
        tok, idx = np.concatenate([tok[~has], many_tok]), np.concatenate([idx[~has], np.full(len(many_tok), MANY, np.uint16)])
        times = many_len
    col = (((tok >> np.uint64(32)) * np.uint64(columns)) >> np.uint64(32)).astype(np.uint16 if columns < MANY else np.int64)
    order = np.argsort(col, kind="stable")
    tok, idx, col = tok[order], idx[order], col[order]
    cuts = np.concatenate([[0], np.flatnonzero(col[1:] != col[:-1]) + 1, [len(col)]]) if len(col) else np.array([0])
    pieces = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    weights = np.ones(len(idx), np.int32)
    weights[idx == MANY] = times[np.searchsorted(many_tok, tok[idx == MANY])] if len(many_tok) else 1
    none = [None] * len(pieces)
    own = [n.astype(np.int32).tobytes(), np.ascontiguousarray(ids).tobytes(), many_tok.tobytes(), many_len.tobytes(), many_idx.tobytes()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*(int(col[a]) for a, _ in pieces), base % columns], pa.int32()),
            pa.array([base] * (len(pieces) + 1), pa.int64()),
            pa.array([*(tok[a:b].tobytes() for a, b in pieces), None], pa.binary()),
            pa.array([*(idx[a:b].tobytes() for a, b in pieces), None], pa.binary()),
            pa.array([*(weights[a:b][idx[a:b] == MANY].tobytes() for a, b in pieces), None], pa.binary()),
            *(pa.array([*none, x], pa.binary()) for x in own),
        ],
        [f.split()[0] for f in SENT.split(", ")],
    )


def counted(table: pa.Table) -> pa.Table:
    """A block of columns: SENT -> BACK, with the shingles of two rows at least and the number df of their rows."""
    tok, sizes = joined(table["tok"], np.uint64)
    idx, _ = joined(table["idx"], np.uint16)
    weights = np.ones(len(tok), np.int64)
    weights[idx == MANY] = joined(table["times"], np.int32)[0]
    order = np.argsort(tok, kind="stable")
    ordered = tok[order]
    fresh = np.ones(len(tok), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    run = np.cumsum(fresh) - 1
    df = np.empty(len(tok), np.int32)
    df[order] = np.minimum(np.bincount(run, weights[order]), 2**31 - 1)[run] if len(tok) else 0
    shared, at = df > 1, np.concatenate([[0], np.cumsum(sizes)]).tolist()
    cut = [(a, b, shared[a:b]) for a, b in zip(at, at[1:])]
    found = [binary([x[a:b][s] for a, b, s in cut]) for x in (tok, idx, df)]
    return pa.table([table["base"], *found, *(table[c] for c in ("n", "ids", "many_tok", "many_len", "many_idx"))], [f.split()[0] for f in BACK.split(", ")])


def restored(percent: int) -> Callable[[pa.Table], pa.Table]:
    """A block of rows, BACK -> PEELED: the rows that can link, each with its shared shingles, rare ones first.

    centre grows with the number of rows that a row's shingles are found in.
    """

    def run(table: pa.Table) -> pa.Table:
        (n, _), (ids, _) = joined(table["n"], np.int32), joined(table["ids"], np.int64)
        (tok, _), (idx, _), (df, _) = joined(table["tok"], np.uint64), joined(table["idx"], np.uint16), joined(table["df"], np.int32)
        (many_tok, _), (many_len, _), (many_idx, _) = joined(table["many_tok"], np.uint64), joined(table["many_len"], np.int32), joined(table["many_idx"], np.uint16)
        many = idx == MANY
        if many.any():
            place = np.searchsorted(many_tok, tok[many])
            count = np.empty(len(many_tok), np.int32)
            count[place] = df[many]
            tok = np.concatenate([tok[~many], np.repeat(many_tok, many_len)])
            idx, df = np.concatenate([idx[~many], many_idx]), np.concatenate([df[~many], np.repeat(count, many_len)])
        m = np.bincount(idx, minlength=len(n))
        kept = np.flatnonzero((n > 0) & (100 * m >= percent * n.astype(np.int64)))
        mine = np.isin(idx, kept)
        tok, idx, df = tok[mine], idx[mine], df[mine]
        order = np.lexsort((tok, df, idx))
        tok, idx, df = tok[order], idx[order], df[order]
        ends = np.searchsorted(idx, kept, side="right").tolist()
        starts = np.searchsorted(idx, kept, side="left").tolist()
        centre = np.bincount(idx, np.log2(df), len(n))[kept] / n[kept] if len(kept) else np.empty(0)
        ids = ids.reshape(-1, 2)[kept]
        rows = [pa.array(n[kept], pa.int32()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), binary([tok[a:b] for a, b in zip(starts, ends)]), pa.array(centre, pa.float64())]
        return pa.table(rows, [f.split()[0] for f in PEELED.split(", ")])

    return run


def peeled(df: DataFrame, rows: Rows, volume: int, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """PEELED of the rows of df, and the written table that it reads; volume: about how many shingles they have."""
    columns = max(df.sparkSession.sparkContext.defaultParallelism * 2, -(-volume // COLUMN_BLOCK))
    sent = df.mapInArrow(row_blocks(rows, columns), SENT)
    back = written(sent.groupBy("col").applyInArrow(counted, BACK), "back")  # the shingles sent have no more use
    return back.groupBy("base").applyInArrow(restored(percent), PEELED), back


POSTED = "token long, p struct<node:long,n:int,m:int,pos:int>, centre double"


def postings(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """token, p, centre: the shared shingles of each node's prefix; nodes: node, n, tokens (PEELED), centre.

    Shingles that no other node has come first in a prefix and needn't be posted; pos counts them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n, centre = (batch.column(i).to_numpy() for i in (0, 1, 3))
            tokens, m = joined(batch.column(2), np.int64)
            own = n - m
            k = np.maximum(prefix_length(n.astype(np.int64), percent) - own, 0)
            row = np.repeat(np.arange(len(n)), k)
            step = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
            p = [pa.array(node[row]), pa.array(n[row], pa.int32()), pa.array(m[row], pa.int32()), pa.array(own[row] + step, pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(tokens[(np.cumsum(m) - m)[row] + step]), pa.StructArray.from_arrays(p, ["node", "n", "m", "pos"]), pa.array(centre[row])], ["token", "p", "centre"])

    return nodes.select("node", "n", "tokens", "centre").mapInArrow(run, POSTED)


def pivot_pairs(posts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b: each posting list's nodes with its most central one, where their sizes allow a link."""
    lists = posts.groupBy("token").agg(F.max_by("p", F.struct("centre", "p.node")).alias("q"), F.count("*").alias("k")).where("k > 1")
    met = posts.join(lists, "token").where("p.node <> q.node")
    met = met.where(F.least("p.m", "q.m") >= needed(F.col("p.n").cast("long"), F.col("q.n").cast("long"), percent))
    return met.select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct()


def overlaps(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b, na, nb and their overlap, for pairs a, b of nodes (node, n, tokens)."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb = batch.column(4), batch.column(5)
            counts = [np.intersect1d(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), assume_unique=True).size for x, y in zip(ta, tb)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(counts, pa.int64())], ["a", "b", "na", "nb", "overlap"])

    rows = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "na", "nb", "ta", "tb")
    return rows.mapInArrow(product, "a long, b long, na int, nb int, overlap long")


def linked(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    o = F.col("overlap")
    return overlaps(pairs, nodes).where(o * 100 >= (F.col("na") + F.col("nb") - o) * percent).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node, root: the least node of each component of links (a, b); nodes without links are left out.

    Each step is written to the shared folder. Rounds are logarithmic in the longest chain.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = written(edges, "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small_star = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(small_star.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # stars only: no node is both a centre and a leaf, and each leaf has one centre
        n, leaves = new.agg(F.count("*"), F.count_distinct("u")).first()
        chained = new.join(new.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        edges = new
        if n == leaves and not chained:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", F.col("v")).distinct())


ENTRY = "token long, block int, node long, c long, n int, m int, pos int, query boolean, member boolean"


def mixed_blocks(posts: DataFrame, roots: DataFrame, list_block: int) -> DataFrame:
    """ENTRY: the postings of lists that hold several components, dealt to blocks of about list_block shingles.

    A member belongs to one block of its list. Queries, the nodes outside the list's largest component,
    visit all its blocks, so that any two nodes of different components meet in a block.
    """
    at = posts.select("token", "p.*").join(roots, "node", "left").select("token", "node", "n", "m", "pos", F.coalesce("root", "node").alias("c"))
    at = written(at, "placed")
    shares = at.groupBy("token", "c").agg(F.count("*").alias("k"), F.sum("m").alias("volume"))
    lists = shares.groupBy("token").agg(F.max_by("c", F.struct("k", "c")).alias("major"), F.count("*").alias("parts"), F.sum("volume").alias("volume")).where("parts > 1")
    lists = lists.select("token", "major", F.ceil(F.col("volume") / list_block).cast("int").alias("blocks"))
    entries = at.join(lists, "token").withColumns({"query": F.col("c") != F.col("major"), "home": F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")})
    visits = F.when(F.col("query"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("home"))
    dealt = entries.withColumn("block", F.explode(visits)).withColumn("member", F.col("block") == F.col("home"))
    return dealt.select(*[f.split()[0] for f in ENTRY.split(", ")])


def _blocks(table: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The columns in the order of their blocks, and where each block begins and ends."""
    block, token = table["block"].to_numpy(), table["token"].to_numpy()
    order = np.lexsort((block, token))
    cols = {c: table[c].to_numpy(zero_copy_only=False)[order] for c in table.column_names if c != "tokens"}
    fresh = np.flatnonzero((cols["token"][1:] != cols["token"][:-1]) | (cols["block"][1:] != cols["block"][:-1])) + 1
    cols["order"] = order
    return cols, np.concatenate([[0], fresh]), np.concatenate([fresh, [len(order)]])


def may_meet(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Of a group of blocks (ENTRY) the entries that some entry of another component may link with, by the bounds."""

    def run(table: pa.Table) -> pa.Table:
        x, starts, ends = _blocks(table)
        block = np.repeat(np.arange(len(starts)), ends - starts)
        left = np.flatnonzero(x["query"])
        room = (ends - starts)[block[left]]
        may = np.zeros(table.num_rows, bool)
        at, sums = 0, np.cumsum(room)
        while at < len(left):
            stop = max(int(np.searchsorted(sums, (sums[at - 1] if at else 0) + PAIRS, side="right")), at + 1)
            i, k = np.repeat(left[at:stop], room[at:stop]), room[at:stop]
            j = starts[block[i]] + np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k)
            i, j = i[ok := x["member"][j] & (x["c"][i] != x["c"][j])], j[ok]
            ni, nj = x["n"][i].astype(np.int64), x["n"][j].astype(np.int64)
            need = -(-percent * (ni + nj) // (100 + percent))
            before = np.minimum(x["pos"][i] - (ni - x["m"][i]), x["pos"][j] - (nj - x["m"][j]))
            ok = (np.minimum(x["m"][i], x["m"][j]) >= need) & (np.minimum(ni - x["pos"][i], nj - x["pos"][j]) + before >= need)
            may[i[ok]] = may[j[ok]] = True
            at = stop
        return table.take(pa.array(x["order"][may]))

    return run


def block_product(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links a, b across components in a group of blocks: ENTRY and tokens; one link for two components."""

    def run(table: pa.Table) -> pa.Table:
        x, starts, ends = _blocks(table)
        rows = [np.frombuffer(v, np.uint64) for v in table["tokens"].to_pylist()]
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for start, end in zip(starts.tolist(), ends.tolist()):
            here = np.arange(start, end)
            members, queries = here[x["member"][start:end]], here[x["query"][start:end]]
            if not len(members):
                continue
            parts = [rows[i] for i in x["order"][members]]
            grams = np.concatenate(parts)
            owner = np.repeat(np.arange(len(members)), list(map(len, parts)))
            order = np.argsort(grams, kind="stable")
            grams, owner = grams[order], owner[order]
            n, c, node = x["n"][members].astype(np.int64), x["c"][members], x["node"][members]
            for q in queries.tolist():
                row = rows[x["order"][q]]
                lo, hi = np.searchsorted(grams, row, "left"), np.searchsorted(grams, row, "right")
                k = hi - lo
                hits = np.repeat(lo - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
                o = np.bincount(owner[hits], minlength=len(members))
                for i in np.flatnonzero((100 * o >= percent * (n + int(x["n"][q]) - o)) & (c != x["c"][q])).tolist():
                    pair = sorted((int(c[i]), int(x["c"][q])))
                    found.setdefault((pair[0], pair[1]), (int(node[i]), int(x["node"][q])))
        a, b = zip(*found.values()) if found else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _grouped(blocks: DataFrame, volume: F.Column, most: int) -> DataFrame:
    """blocks with g: groups of whole blocks with about `most` of volume."""
    total = blocks.agg(F.coalesce(F.sum(volume), F.lit(0))).first()[0]
    groups = max(blocks.sparkSession.sparkContext.defaultParallelism * 2, -(-total // most))
    return blocks.withColumn("g", F.pmod(F.xxhash64("token", "block"), F.lit(groups)))


def cross_links(posts: DataFrame, roots: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b: for any two components with links between them, some of those links. roots: node, root."""
    entries = written(mixed_blocks(posts, roots, LIST_BLOCK), "mixed")
    met = _grouped(entries, F.lit(1), 50_000).groupBy("g").applyInArrow(lambda t: may_meet(percent)(t.drop_columns(["g"])), ENTRY)
    met = written(met, "met")
    whole = _grouped(met, F.col("m") * 8, GROUP_BYTES).join(nodes.select("node", "tokens"), "node")
    return whole.groupBy("g").applyInArrow(block_product(percent), "a long, b long")


def similarity_classes(docs: DataFrame, carry: list[str], percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): carry's columns with n, d1, d2; and of every digest d1, d2: least (first carried column), r1, r2.

    Digests with one r1, r2 are a component; a digest that links with no other has its own. docs needs
    text; carry[0] orders the members of a class. Null and empty texts have no shingles and are in no
    class; rows with equal shingles share a digest; a very long text is a block of rows of its own; an
    empty table gives empty tables.
    """
    rows = written(sizes_and_digests(docs, carry), "rows")
    volume = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared, back = peeled(docs.select("text"), text_rows, volume, percent)
    shared = written(shared.groupBy("id1", "id2").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")), "shared")
    discard(back)
    volume = shared.agg(F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0))).first()[0] // 8
    nodes, back = peeled(shared.select("n", "id1", "id2", "tokens"), node_rows, volume, percent)
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    discard(back, shared)
    posts = written(postings(nodes, percent), "posts")
    links = written(linked(pivot_pairs(posts, percent), nodes, percent), "links")
    roots = written(components(links), "roots")
    more = written(cross_links(posts, roots, nodes, percent), "links")
    roots = written(components(links.union(more)), "roots")
    digest = nodes.select("node", "id1", "id2")
    placed = digest.join(roots, "node").select(F.col("id1").alias("d1"), F.col("id2").alias("d2"), F.col("root").alias("node"))
    placed = placed.join(digest, "node").select("d1", "d2", F.col("id1").alias("r1"), F.col("id2").alias("r2"))
    classes = rows.where("n > 0").groupBy("d1", "d2").agg(F.min(carry[0]).alias("least")).join(placed, ["d1", "d2"], "left")
    return rows, classes.select("d1", "d2", "least", F.coalesce("r1", "d1").alias("r1"), F.coalesce("r2", "d2").alias("r2"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links) of every document.

    Null and empty texts have no shingles and are their own component; repeated rows are one class; null
    ids name a class only where it has no other; very long texts are compared whole; an empty table
    stays empty; further columns don't matter.
    """
    rows, classes = similarity_classes(docs, ["doc_id"])
    heads = classes.groupBy("r1", "r2").agg(F.min("least").alias("head"))
    named = classes.join(heads, ["r1", "r2"]).select("d1", "d2", "head")
    n = F.col("n").cast("long").alias("n_shingles")
    found = rows.where("n > 0").join(named, ["d1", "d2"]).select("doc_id", n, F.coalesce("head", "doc_id").alias("component_id"))
    return found.unionByName(rows.where("n = 0").select("doc_id", n, F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs with one row of each component: the one with the least key (nulls last; ties by a hash of the text).

    Rows without words stay. The columns are those of docs. Texts are shuffled only where rows are alike
    in key and text.
    """
    mark, pick, gone = unused(docs, "mark_", "pick_", "gone_")
    keyed = docs.select(F.col(f"`{key}`").alias(pick), F.xxhash64("text").alias(mark), "text")
    rows, classes = similarity_classes(keyed, [pick, mark])
    placed = rows.where("n > 0").join(classes.select("d1", "d2", "r1", "r2"), ["d1", "d2"]).select("r1", "r2", pick, mark)
    order = F.struct(F.col(pick).isNull(), F.col(pick), F.col(mark))
    best = placed.groupBy("r1", "r2").agg(F.min_by(F.struct(pick, mark), order).alias("best"), F.count("*").alias("rows"))
    many = best.where("rows > 1")
    members = placed.join(many, ["r1", "r2"])
    same = F.col(pick).eqNullSafe(F.col(f"best.{pick}")) & F.col(mark).eqNullSafe(F.col(f"best.{mark}"))
    dropped = small(members.where(~same).select(F.col(pick).alias(gone), F.col(mark).alias(mark)).distinct(), KEYS)
    twice = small(members.where(same).groupBy(pick, mark).agg(F.count("*").alias("k")).where("k > 1").drop("k"), KEYS)
    left = docs.withColumn(f"{mark}_", F.xxhash64("text"))
    left = left.join(dropped, F.col(f"`{key}`").eqNullSafe(F.col(gone)) & (F.col(f"{mark}_") == F.col(mark)), "left_anti")
    again = F.col(f"`{key}`").eqNullSafe(F.col(pick)) & (F.col(f"{mark}_") == F.col(mark))
    once = left.join(twice, again, "left_anti").select(*docs.columns)
    return once.unionByName(left.join(twice, again, "left_semi").dropDuplicates([key, f"{mark}_"]).select(*docs.columns))


SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0),
s AS MATERIALIZED (SELECT DISTINCT rid, md5(array_to_string(w[i:i + 4], ' ')) AS h FROM g),
n AS MATERIALIZED (SELECT rid, count(*) AS n FROM s GROUP BY rid),
o AS (SELECT x.rid AS a, y.rid AS b, count(*) AS o FROM s x JOIN s y ON x.h = y.h AND x.rid < y.rid GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM o JOIN n p ON p.rid = a JOIN n q ON q.rid = b WHERE 100 * o >= 80 * (p.n + q.n - o)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT rid, rid FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM w LEFT JOIN n ON w.rid = n.rid
JOIN (SELECT r.a, min(v.doc_id) AS component_id FROM r JOIN w v ON v.rid = r.b GROUP BY r.a) c ON c.a = w.rid
"""
