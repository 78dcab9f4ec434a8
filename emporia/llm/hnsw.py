"""Embedding near-duplicates: hierarchical navigable small-world graphs per shard.

Equal vectors are one class with a number of copies. The classes are dealt by
hash to shards of at most ``SHARD_ROWS`` and ``SHARD_BYTES``; each shard grows an
HNSW graph in one task. Every class then searches every shard: the shards are broadcast one after
another (their size is bounded), and blocks of queries walk each graph together.
A query whose beam is full of links stands in a crowd that beams would have to walk node by node: it is
compared with that shard by a matrix product, in steps of bounded bytes. All hits
are verified by cosine in double precision, and a link counts for both ends, whichever of
them found it. Then an audit counts the links of
classes by brute force over all rows: blocks of a random sample, until enough classes
with few links are among them or ``AUDIT_BLOCKS`` are drawn, then also classes that the
searches have linked. Each audited class with links weighs the same: while their
searches have found less than ``RECALL`` of a class's links on average, or so much
for less than that share of the classes, among all or among those with few links,
all beams are widened to twice their width and searched again. An audit that meets no links says so in the log. Links join into
components; a task sends a spanning forest of its links and one count for each
query, never pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, vectors of different lengths neither; a row without
id counts as a vector but names no component; equal vectors link with each
other; repeated ids are rows of their own.
"""

from __future__ import annotations

import logging
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import staged
from emporia.llm.graph import connected_components
from emporia.session import scratch_path

SHARD_ROWS, SHARD_BYTES = 50_000, 64 << 20
#: Bytes of similarities that one matrix product makes.
PRODUCT_BYTES = 32 << 20
MIN_SHARDS = 4
M, EF_BUILD, EF = 12, 48, 32
BLOCK = 512
AUDIT, AUDIT_BLOCKS, RECALL = 2048, 16, 0.99
#: Classes with at most FEW linked classes have few links; so many of them are enough for the audit.
FEW, ENOUGH = 8, 256

log = logging.getLogger(__name__)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision and safe from overflow."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


class HNSW:
    """Navigable small-world graph over unit vectors, built and searched in blocks."""

    def __init__(self, vectors: np.ndarray, seed: int = 1):
        self.exact = vectors
        self.x = vectors.astype(np.float32)
        n = len(vectors)
        rng = np.random.default_rng(seed)
        level = np.minimum((-np.log(rng.random(n)) / np.log(M)).astype(int), 8)
        self.links = [np.full((n, 2 * M if k == 0 else M), -1, np.int32) for k in range(level.max(initial=0) + 1)]
        # the highest nodes first, so that upper levels are complete when they are walked
        order = np.argsort(-level, kind="stable")
        self.entry = int(order[0]) if n else -1
        at = 1
        while at < n:
            block = order[at:at + min(BLOCK, at)]
            self._insert(block, level[block])
            at += len(block)
        self._adopt()

    def __getstate__(self):
        return {"exact": self.exact, "links": self.links, "entry": self.entry}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.x = self.exact.astype(np.float32)

    def beam(self, q: np.ndarray, start: np.ndarray, ef: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` best nodes that each query reaches from its start nodes (-1: none), best first."""
        links, x = self.links[level], self.x
        rows = len(q)
        width = max(ef, start.shape[1])
        ids = np.full((rows, width), -1, np.int64)
        ids[:, :start.shape[1]] = start
        sims = np.where(ids >= 0, np.einsum("bed,bd->be", x[ids], q), -np.inf)
        order = np.argsort(-sims, 1, kind="stable")[:, :ef]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        done = ids < 0
        live = np.arange(rows)
        while len(live):
            best = np.argmax(np.where(done[live], -np.inf, sims[live]), 1)
            open_ = ~done[live, best]
            live, best = live[open_], best[open_]
            if not len(live):
                break
            done[live, best] = True
            near = links[ids[live, best]].astype(np.int64)
            fresh = (near >= 0) & ~(near[:, :, None] == ids[live][:, None, :]).any(2)
            s = np.where(fresh, np.einsum("bed,bd->be", x[near], q[live]), -np.inf)
            better = s.max(1) > sims[live, -1]
            rows_, near, s = live[better], near[better], s[better]
            if len(rows_):
                all_ids = np.concatenate([ids[rows_], near], 1)
                all_sims = np.concatenate([sims[rows_], s], 1)
                all_done = np.concatenate([done[rows_], np.zeros(near.shape, bool)], 1)
                order = np.argsort(-all_sims, 1, kind="stable")[:, :ef]
                all_sims = np.take_along_axis(all_sims, order, 1)
                none = all_sims == -np.inf
                ids[rows_] = np.where(none, -1, np.take_along_axis(all_ids, order, 1))
                sims[rows_] = all_sims
                done[rows_] = np.take_along_axis(all_done, order, 1) | none
        return ids, sims

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of candidates, best first, those nearer to the node than to any one kept before; then the best others."""
        out = np.full((len(ids), most), -1, np.int32)
        for lo in range(0, len(ids), BLOCK):
            i, s = ids[lo:lo + BLOCK], sims[lo:lo + BLOCK]
            v = self.x[i]
            mutual = np.einsum("bed,bfd->bef", v, v)
            kept = np.zeros(i.shape, bool)
            for c in range(i.shape[1]):
                rival = np.where(kept[:, :c], mutual[:, c, :c], -np.inf).max(1, initial=-np.inf)
                kept[:, c] = (i[:, c] >= 0) & (s[:, c] > rival) & (kept.sum(1) < most)
            order = np.argsort(np.where(kept, 0, np.where(i >= 0, 1, 2)), 1, kind="stable")[:, :most]
            out[lo:lo + BLOCK, :order.shape[1]] = np.take_along_axis(i, order, 1)
        return out

    def _insert(self, block: np.ndarray, level: np.ndarray) -> None:
        q = self.x[block]
        start = np.full((len(block), 1), self.entry, np.int64)
        mates = q @ q.T
        np.fill_diagonal(mates, -np.inf)
        for k in range(len(self.links) - 1, -1, -1):
            own = level >= k
            if (~own).any():
                start[~own, :1] = self.beam(q[~own], start[~own, :1], 1, k)[0]
            if own.any():
                ids, sims = self.beam(q[own], start[own], EF_BUILD, k)
                # nodes of the same block are candidates too
                m = np.where(own[None, :], mates[own], -np.inf)
                some = np.argsort(-m, 1, kind="stable")[:, :EF_BUILD // 2]
                m, some = np.take_along_axis(m, some, 1), block[some]
                m[(some[:, :, None] == ids[:, None, :]).any(2)] = -np.inf  # the walk may have begun at one
                ids = np.concatenate([ids, np.where(m > -np.inf, some, -1)], 1)
                sims = np.concatenate([sims, m], 1)
                order = np.argsort(-sims, 1, kind="stable")[:, :EF_BUILD]
                ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
                self.links[k][block[own]] = self._diverse(ids, sims, self.links[k].shape[1])
                self._link_back(block[own], k)
                start[own, :1] = np.where(ids[:, :1] >= 0, ids[:, :1], start[own, :1])

    def _adopt(self) -> None:
        """Give every node that no other one links to a link from its nearest neighbour, in further columns."""
        links = self.links[0]
        linked = np.bincount(links[links >= 0], minlength=len(links)) > 0
        lost = np.flatnonzero(~linked & (links[:, 0] >= 0))
        parent = links[lost, 0]
        order = np.argsort(parent, kind="stable")
        lost, parent = lost[order], parent[order]
        head = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]]) if len(lost) else np.zeros(0, int)
        place = np.arange(len(lost)) - np.repeat(head, np.diff(np.r_[head, len(lost)]))
        more = np.full((len(links), place.max(initial=-1) + 1), -1, np.int32)
        more[parent, place] = lost
        self.links[0] = np.concatenate([links, more], 1)

    def _link_back(self, block: np.ndarray, k: int) -> None:
        links = self.links[k]
        most = links.shape[1]
        to = links[block]
        frm = np.repeat(block, most)[to.ravel() >= 0]
        to = to.ravel()[to.ravel() >= 0]
        known = (links[to] == frm[:, None]).any(1)
        frm, to = frm[~known], to[~known]
        order = np.argsort(to, kind="stable")
        frm, to = frm[order], to[order]
        while len(to):
            head = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            place = np.arange(len(to)) - np.repeat(head, np.diff(np.r_[head, len(to)]))
            now = place < most  # the rest of a crowded node's new links in the next turn
            nodes = to[head]
            new = np.full((len(nodes), most), -1, np.int64)
            row = np.cumsum(np.r_[True, to[1:] != to[:-1]]) - 1
            new[row[now], place[now]] = frm[now]
            ids = np.concatenate([links[nodes], new], 1)
            full = (ids >= 0).sum(1) > most
            easy = ids[~full]
            order = np.argsort(easy < 0, 1, kind="stable")[:, :most]
            links[nodes[~full]] = np.take_along_axis(easy, order, 1)
            if full.any():
                ids = ids[full]
                sims = np.where(ids >= 0, np.einsum("bed,bd->be", self.x[ids], self.x[nodes[full]]), -np.inf)
                order = np.argsort(-sims, 1, kind="stable")
                links[nodes[full]] = self._diverse(np.take_along_axis(ids, order, 1),
                                                   np.take_along_axis(sims, order, 1), most)
            frm, to = frm[~now], to[~now]

    def within(self, q: np.ndarray, threshold: float, ef: int, own: np.ndarray | None = None):
        """``(query rows, nodes, crowded)``: pairs with a cosine of at least the threshold that the search finds, and
        which queries were compared with all nodes, since more than a beam is near them.

        ``own``: each query's node in this graph, or -1; it is a start node too.
        """
        none = np.zeros(0, np.int64)
        if self.entry < 0 or not len(q):
            return none, none, np.zeros(len(q), bool)
        if ef >= len(self.x):
            return *self.all_within(q, threshold), np.ones(len(q), bool)
        q32 = q.astype(np.float32)
        start = np.full((len(q), 1), self.entry, np.int64)
        for k in range(len(self.links) - 1, 0, -1):
            start = self.beam(q32, start, 1, k)[0]
        if own is not None:
            start = np.concatenate([start, np.where(own == start[:, 0], -1, own)[:, None]], 1)
        ids, sims = self.beam(q32, start, ef, 0)
        # a beam that holds links only may have cut some off
        crowded = sims[:, -1] >= threshold - 1e-4
        rows, c = np.nonzero((sims >= threshold - 1e-4) & ~crowded[:, None])
        nodes = ids[rows, c]
        sure = self._sure(q, rows, nodes, threshold)
        full = np.flatnonzero(crowded)
        full_rows, full_nodes = self.all_within(q[full], threshold)
        return np.concatenate([rows[sure], full[full_rows]]), np.concatenate([nodes[sure], full_nodes]), crowded

    def all_within(self, q: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """All ``(query rows, nodes)`` with a cosine of at least the threshold, by matrix products."""
        q32, found_q, found_n = q.astype(np.float32), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step = max(1, PRODUCT_BYTES // (4 * max(1, len(self.x))))
        for lo in range(0, len(q), step):
            sims = q32[lo:lo + step] @ self.x.T
            r, c = np.nonzero(sims >= threshold - 1e-4)
            near = np.flatnonzero(sims[r, c] < threshold + 1e-4)  # single precision can't tell
            keep = np.ones(len(r), bool)
            keep[near] = self._sure(q, r[near] + lo, c[near], threshold)
            found_q.append(r[keep] + lo)
            found_n.append(c[keep])
        return np.concatenate(found_q), np.concatenate(found_n)

    def _sure(self, q: np.ndarray, rows: np.ndarray, nodes: np.ndarray, threshold: float) -> np.ndarray:
        sure = np.zeros(len(rows), bool)
        for lo in range(0, len(rows), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            sure[part] = (q[rows[part]] * self.exact[nodes[part]]).sum(1) >= threshold
        return sure


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as ``(a, b)``: one for each node but its component's first."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _vectors(batch) -> np.ndarray:
    flat = batch.column("v").combine_chunks() if isinstance(batch, pa.Table) else batch.column("v")
    return unit(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1))


def _classes(rows: DataFrame) -> DataFrame:
    """Distinct usable vectors: ``(class, v, dim, copies, least)``."""
    v = F.col("v")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda c: c != 0)
    return (rows.where(usable).groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
            .select(F.monotonically_increasing_id().alias("class"), "v", F.size("v").alias("dim"), "copies", "least"))


def shard_of(node: str, shards: int):
    return F.pmod(F.xxhash64(node), F.lit(shards)).cast("int")


def build_shards(classes: DataFrame, shards: int) -> DataFrame:
    """One row for each shard and vector length: its classes, copies and graph."""
    def build(table: pa.Table) -> pa.Table:
        dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
        order = np.argsort(table.column("class").to_numpy())
        graph = HNSW(_vectors(table)[order], seed=shard)
        raw = pickle.dumps((table.column("class").to_numpy()[order], table.column("copies").to_numpy()[order], graph),
                           protocol=5)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
                         "graph": pa.array([raw], pa.large_binary()).cast(pa.binary())})

    dealt = classes.withColumn("shard", shard_of("class", shards))
    return dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, graph binary")


_LINKS = "shard int, a bigint, b bigint, n_a bigint, n bigint"


def _search(shared, threshold: float, ef: int, shard: int):
    def run(batches):
        ids, copies, graph = pickle.loads(shared.value)
        for batch in batches:
            key, own_copies = batch.column("class").to_numpy(), batch.column("copies").to_numpy()
            q = _vectors(batch)
            place = np.minimum(np.searchsorted(ids, key), len(ids) - 1)
            own = np.where(ids[place] == key, place, -1)
            for lo in range(0, len(key), BLOCK):
                part = slice(lo, lo + BLOCK)
                r, node, crowded = graph.within(q[part], threshold, ef, own[part])
                k, c = key[part], own_copies[part]
                other = k[r] != ids[node]
                r, node = r[other], node[other]
                # a crowded query sends its count and a spanning forest, any other its links
                many = crowded[r]
                n = np.bincount(r[many], copies[node[many]], len(k)).astype(np.int64)
                some = np.flatnonzero(crowded)
                a, b = forest(k[r[many]], ids[node[many]]) if many.any() else (k[:0], k[:0])
                zero = np.zeros(len(a), np.int64)
                r, node = r[~many], node[~many]
                columns = [np.concatenate(x) for x in ((k[some], a, k[r]), (k[some], b, ids[node]),
                                                       (c[some], zero, c[r]), (n[some], zero, copies[node]))]
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(columns[0]), shard, np.int32)), *map(pa.array, columns)],
                        ["shard", "a", "b", "n_a", "n"])
    return run


def search_shards(classes: DataFrame, graphs: DataFrame, threshold: float, ef: int) -> DataFrame:
    """``(shard, a, b, n_a, n)``, a written table: links a-b with the copies of both, links without copies that only
    join components, and for a = b the linked copies of a class that was compared with the whole shard."""
    spark = classes.sparkSession
    path = scratch_path(spark, "links")
    spark.createDataFrame([], _LINKS).write.parquet(path)
    keys = [(r.dim, r.shard) for r in graphs.select("dim", "shard").orderBy("dim", "shard").collect()]
    for dim, shard in keys:
        here = (F.col("dim") == dim) & (F.col("shard") == shard)
        shared = spark.sparkContext.broadcast(bytes(graphs.where(here).first().graph))
        (classes.where(F.col("dim") == dim).select("class", "copies", "v")
         .mapInArrow(_search(shared, threshold, ef, shard), _LINKS).write.mode("append").parquet(path))
        shared.destroy()
    return spark.read.schema(_LINKS).parquet(path)


def link_counts(links: DataFrame, shards: int) -> DataFrame:
    """``(class, n)``: the linked copies of each class, each link counted once for both its ends.

    What b's search didn't find but a's did counts for b too, unless b was compared with all of a's shard.
    """
    whole = links.where("a = b").select(F.col("a").alias("class"), "shard", "n")
    found = links.where("a <> b AND n > 0")
    back = (found.select(F.col("b").alias("class"), F.col("a").alias("other"), F.col("n_a").alias("n"),
                         shard_of("a", shards).alias("shard"))
            .join(whole.select("class", "shard"), ["class", "shard"], "left_anti").select("class", "other", "n"))
    single = found.select(F.col("a").alias("class"), F.col("b").alias("other"), "n").unionByName(back)
    return (single.dropDuplicates(["class", "other"]).select("class", "n").unionByName(whole.select("class", "n"))
            .groupBy("class").agg(F.sum("n").alias("n")))


def exact_links(classes: DataFrame, queries: list, threshold: float) -> dict[int, tuple[int, int]]:
    """``class: (linked copies, linked classes)`` of the bounded queries that have any, by brute force over all rows."""
    by_dim: dict = {}
    for r in queries:
        by_dim.setdefault(r.dim, ([], []))[0].append(r["class"])
        by_dim[r.dim][1].append(r.v)
    shared = classes.sparkSession.sparkContext.broadcast(
        {d: (np.array(k), unit(np.array(v, np.float64))) for d, (k, v) in by_dim.items()})

    def run(batches):
        total: dict = {}
        for batch in batches:
            dims, key, copies = (batch.column(c).to_numpy() for c in ("dim", "class", "copies"))
            for d in np.unique(dims):
                if d not in shared.value:
                    continue
                ids, q = shared.value[d]
                rows = np.flatnonzero(dims == d)
                x = _vectors(batch.take(pa.array(rows)))
                linked = (q @ x.T >= threshold) & (ids[:, None] != key[rows][None, :])
                n, m = linked @ copies[rows], linked.sum(1)
                for i in np.flatnonzero(m):
                    was = total.get(int(ids[i]), (0, 0))
                    total[int(ids[i])] = was[0] + int(n[i]), was[1] + int(m[i])
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()),
                                              *(pa.array([t[k] for t in total.values()], pa.int64()) for k in (0, 1))],
                                             ["class", "n", "m"])

    found = (classes.mapInArrow(run, "class bigint, n bigint, m bigint").groupBy("class")
             .agg(F.sum("n").alias("n"), F.sum("m").alias("m")).collect())
    shared.destroy()
    return {r["class"]: (r.n, r.m) for r in found}


def n_few(audit: dict) -> int:
    """How many audited classes have few links."""
    return sum(m <= FEW for _, m in audit.values())


def audit_sample(classes: DataFrame, threshold: float, sample: int = AUDIT, blocks: int = AUDIT_BLOCKS) -> dict:
    """The exact links of classes drawn at random, block by block, until enough have few links."""
    audit, last = {}, None
    order = F.xxhash64("class", F.lit("audit"))
    for _ in range(blocks):
        rest = classes.select("class", "dim", "v", order.alias("at"))
        if last is not None:
            rest = rest.where((F.col("at") > last.at) | ((F.col("at") == last.at) & (F.col("class") > last["class"])))
        drawn = rest.orderBy("at", "class").limit(sample).collect()
        if drawn:
            audit |= exact_links(classes, drawn, threshold)
            last = drawn[-1]
        if len(drawn) < sample or n_few(audit) >= ENOUGH:
            break
    return audit


def audit_linked(classes: DataFrame, links: DataFrame, counts: DataFrame, threshold: float, sample: int = AUDIT) -> dict:
    """The exact links of classes that the searches have linked from either end, those with few links first."""
    nodes = links.where("a <> b").select(F.explode(F.array("a", "b")).alias("class")).distinct()
    drawn = (classes.select("class", "dim", "v").join(nodes, "class", "left_semi").join(counts, "class", "left")
             .orderBy(F.coalesce("n", F.lit(0)) > FEW, F.xxhash64("class", F.lit("audit"))).limit(sample).collect())
    return exact_links(classes, drawn, threshold) if drawn else {}


def enough_found(audit: dict, found: dict, recall: float) -> bool:
    """Whether the links found reach the recall, each audited class weighing the same, also where links are few."""
    share = np.array([min(found.get(k, 0), n) / n for k, (n, _) in audit.items()])
    few = np.array([m <= FEW for _, m in audit.values()], bool)
    return all(s.mean() >= recall and (s >= recall).mean() >= recall for s in (share, share[few]) if len(s))


def found_links(counts: DataFrame, audit: dict) -> dict[int, int]:
    """The links that the searches have found of the audited classes."""
    asked = counts.sparkSession.createDataFrame([(k,) for k in audit], "class bigint")
    return {r["class"]: r.n for r in counts.join(F.broadcast(asked), "class").collect()}


def link_embeddings(rows: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding",
                    ef: int = EF, shard_rows: int = SHARD_ROWS, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id)`` for every row."""
    rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v"))
    # -0.0 and 0.0 are one number
    rows = staged(rows.withColumn("v", F.transform("v", lambda c: F.when(c == 0, c * 0 + F.abs(c * 0)).otherwise(c))),
                  "vectors")
    classes = staged(_classes(rows), "classes")
    total, dim = classes.agg(F.count(F.lit(1)), F.max("dim")).first()
    most = max(1, min(shard_rows, SHARD_BYTES // (8 * (dim or 1))))
    shards = max(MIN_SHARDS, -(-total // most))
    graphs = staged(build_shards(classes, shards), "graphs")
    audit = audit_sample(classes, threshold)
    first = True
    while True:
        links = search_shards(classes, graphs, threshold, ef)
        counts = staged(link_counts(links, shards), "link-counts")
        if first and n_few(audit) < ENOUGH:
            audit |= audit_linked(classes, links, counts, threshold)
        if first and n_few(audit) < ENOUGH:
            log.warning("op7_hnsw: of %d classes the audit met %d with links, %d with few", total, len(audit),
                        n_few(audit))
        first = False
        if enough_found(audit, found_links(counts, audit), recall) or ef >= max(total, 1):
            break
        ef *= 2
    roots = connected_components(links.select("a", "b"))
    named = (classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
             .withColumn("root", F.coalesce("root", "class")))
    named = staged(named.join(counts, "class", "left").select("v", "root", "copies", "least", F.coalesce(
        "n", F.lit(0)).alias("n")), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("v", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    return (rows.join(named, "v", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
                    .alias("component_id")))
