"""Long exact spans shared between documents.

Windows that are repeated at one length alone are extended to twice that length. The start
length is half the required one. At the start length only *anchors* are looked at: of every
window of the required length the sub-window with the least hash, so that any span of the
required length holds an anchor at the same place in every document that has it, while only
some two per cent of all windows are anchors. Anchors found in one document alone are dropped.
The others are extended towards the required length: in groups of few occurrences directly,
by comparing the characters beside the anchor; in larger groups level by level, each level
regrouping by a hash over half of the characters still missing, until a group is small or the
window has its full length. No level emits pairs of a group that may yet fall apart, so the work
follows the repeated text, not the square of a common phrase's occurrences.

Only small groups are brought together. Occurrences in large groups are regrouped row by row where
they lie, and group sizes come from partial counts. An anchor that very many documents hold, such
as a page header's, would still gather in one task when anchors are first compared: such keys are
found in a sample of documents beforehand and, known to be repeated, are never gathered.

Exact copies are compared once, through a representative. Windows are told apart by 128 bits of
hash, and beyond the anchor in small groups by their characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.sliced import bounded
from strata.session import written

MIN_CHARS = 200
#: Groups of at most this many anchors are compared directly; larger ones are split further.
DIRECT = 32
#: Documents looked at for common anchors, and how many of them must hold one.
SAMPLE, COMMON = 4_000, 8
_CHUNK = 1 << 19  # characters hashed at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _window_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash (mod 2^64) of each window of k characters, by doubling."""
    one = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    one ^= one >> np.uint64(29)
    out, done = None, 0
    size, power = 1, _BASE
    with np.errstate(over="ignore"):
        while True:
            if k & size:
                if out is None:
                    out, done = one, size
                else:
                    n = len(codes) - done - size + 1
                    out, done = out[:n] * power + one[done : done + n], done + size
            if size * 2 > k:
                break
            n = len(codes) - 2 * size + 1
            one = one[:n] * power + one[size : size + n]
            power, size = power * power, size * 2
        out = out ^ (out >> np.uint64(31))
        return (out * _MIX) ^ (out >> np.uint64(7))


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over x[i : i + width] for each i, by doubling."""
    size = 1
    while size * 2 <= width:
        x = best(x[: len(x) - size], x[size:])
        size *= 2
    rest = width - size
    return best(x[: len(x) - rest], x[rest:]) if rest else x


def _anchors_of(texts: list[str], k: int, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of text, position, hash) of all anchors; texts are at least `need` long."""
    codes = _codes("".join(texts))
    sizes = np.array([len(t) for t in texts])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    h = _window_hashes(codes, k)
    w = need - k + 1
    least = _sliding(h, w, np.minimum)  # of the windows of `need` characters
    marks = np.zeros(len(codes) + 1, dtype=np.int8)
    marks[offsets[:-1]] = 1
    marks[offsets[1:] - need + 1] -= 1
    inside = np.cumsum(marks[: len(least)], dtype=np.int8).view(bool)
    least[~inside] = 0
    padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    chosen = np.flatnonzero(_sliding(padded, w, np.maximum)[: len(h)] == h)
    which = np.searchsorted(offsets, chosen, side="right") - 1
    pos = chosen - offsets[which]
    ok = pos + k <= sizes[which]
    return which[ok], pos[ok], h[chosen[ok]]


def _pieces(ids: list, texts: list, need: int) -> Iterator[tuple[int, int, int, int, str]]:
    """(id, offset, first and last position that count, text): long texts in overlapping pieces."""
    for i, t in zip(ids, texts, strict=True):
        if i is None or t is None or len(t) < need:
            continue
        for at in range(0, len(t), _CHUNK):
            a = max(0, at - need)
            piece = t[a : at + _CHUNK + need]
            if len(piece) >= need:
                yield i, a, at - a, at - a + _CHUNK, piece


def _anchor_batches(k: int, need: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(todo: list) -> pa.RecordBatch:
            which, pos, h = _anchors_of([p[4] for p in todo], k, need)
            doc, off, lo, hi = (np.array([p[i] for p in todo], dtype=np.int64) for i in range(4))
            ok = (pos >= lo[which]) & (pos < hi[which])
            which, pos, h = which[ok], pos[ok], h[ok]
            return pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(doc[which]), pa.array((pos + off[which]).astype(np.int32))], names=["key", "doc", "pos"]
            )

        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                todo, size = [], 0
                for p in _pieces(part.column(0).to_pylist(), part.column(1).to_pylist(), need):
                    todo.append(p)
                    size += len(p[4])
                    if size >= _CHUNK:
                        yield flush(todo)
                        todo, size = [], 0
                if todo:
                    yield flush(todo)

    return run


_ROW = "key long, mark long, large boolean, doc long, lo int, hi int, before string, after string"
_COLUMNS = [c.split()[0] for c in _ROW.split(", ")]


def _context_batches(k: int, need: int):
    """Each anchor of a text with the characters beside it that a window of `need` may reach. Read
    by position from decoded text, so the work is linear in its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        c = need - k
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                texts, spots = part.column("text").to_pylist(), part.column("spots")
                flat = pa.array(spots).flatten()
                owner = np.repeat(np.arange(part.num_rows), spots.value_lengths().to_numpy(zero_copy_only=False))
                at = flat.field("pos").to_numpy()
                where = list(zip(owner.tolist(), at.tolist(), strict=True))
                before = [texts[i][max(0, p - c) : p][::-1] for i, p in where]
                after = [texts[i][p + k : p + need] for i, p in where]
                mark = np.array([xxhash.xxh3_64_intdigest(texts[i][p : p + k].encode("utf-8", "surrogatepass")) for i, p in where], dtype=np.uint64).view(np.int64)
                doc = part.column("doc").to_numpy()[owner]
                yield pa.RecordBatch.from_arrays(
                    [flat.field("key"), pa.array(mark), flat.field("large"), pa.array(doc), pa.array(at), pa.array((at + k).astype(np.int32)), pa.array(before, pa.string()), pa.array(after, pa.string())],
                    names=_COLUMNS,
                )

    return run


_OUT = "kind byte, a long, b long, " + _ROW
_PAIR, _COVER, _DEEPER, _EQUAL = 0, 1, 2, 3


def _block(kind: int, n: int, **cols) -> pa.RecordBatch:
    types = {"a": pa.int64(), "b": pa.int64(), "key": pa.int64(), "mark": pa.int64(), "large": pa.bool_(), "doc": pa.int64(), "lo": pa.int32(), "hi": pa.int32(), "before": pa.string(), "after": pa.string()}
    arrays = [pa.array(np.full(n, kind, np.int8))] + [pa.array(cols[c], t) if c in cols else pa.nulls(n, t) for c, t in types.items()]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", *types])


def _matrix(texts: list[str], c: int) -> np.ndarray:
    return np.array(texts, dtype=f"U{max(c, 1)}").view(np.uint32).reshape(len(texts), max(c, 1))[:, :c]


def _agree(m: np.ndarray, size: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Length of the common start of rows u and v."""
    if not m.shape[1]:  # nothing is missing
        return np.zeros(len(u), dtype=np.int64)
    differ = m[u] != m[v]
    n = np.where(differ.any(axis=1), differ.argmax(axis=1), m.shape[1])
    return np.minimum(n, np.minimum(size[u], size[v]))


def _direct(rows: pa.Table, starts: np.ndarray, sizes: np.ndarray, c: int, cover: bool) -> Iterator[pa.RecordBatch]:
    """All pairs of occurrences within small groups: they share a window of full length exactly
    if the characters agreeing before and after the key's window make up what is missing."""
    doc = rows.column("doc").to_numpy()
    lo, hi = rows.column("lo").to_numpy(), rows.column("hi").to_numpy()
    before, after = rows.column("before").to_pylist(), rows.column("after").to_pylist()
    u, v = [], []
    for m in np.unique(sizes):
        i, j = np.triu_indices(m, 1)
        s = starts[sizes == m]
        u.append((s[:, None] + i).ravel())
        v.append((s[:, None] + j).ravel())
    u, v = np.concatenate(u), np.concatenate(v)
    other = doc[u] != doc[v]
    u, v = u[other], v[other]
    if not len(u):
        return
    used = np.unique(np.concatenate([u, v]))
    place = np.zeros(len(doc), dtype=np.int64)
    place[used] = np.arange(len(used))
    mb, ma = _matrix([before[i] for i in used], c), _matrix([after[i] for i in used], c)
    nb, na = (np.array([len(x[i]) for i in used]) for x in (before, after))
    left, right = np.empty(len(u), np.int64), np.empty(len(u), np.int64)
    for at in range(0, len(u), 20_000):
        pu, pv = place[u[at : at + 20_000]], place[v[at : at + 20_000]]
        left[at : at + 20_000], right[at : at + 20_000] = _agree(mb, nb, pu, pv), _agree(ma, na, pu, pv)
    same = left + right >= c
    u, v, left, right = u[same], v[same], left[same], right[same]
    if not len(u):
        return
    pairs = np.unique(np.sort(np.stack([doc[u], doc[v]], axis=1), axis=1), axis=0)
    yield _block(_PAIR, len(pairs), a=pairs[:, 0], b=pairs[:, 1])
    if cover:
        far_l, far_r = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
        for x in (u, v):
            np.maximum.at(far_l, x, left)
            np.maximum.at(far_r, x, right)
        hit = np.unique(np.concatenate([u, v]))
        yield _block(_COVER, len(hit), doc=doc[hit], lo=(lo[hit] - far_l[hit]).astype(np.int32), hi=(hi[hit] + far_r[hit]).astype(np.int32))


def _split(rows: DataFrame, c: int) -> DataFrame:
    """Occurrences of large groups, regrouped by half of what is missing: a window of full length
    reaches over that half on the one side or on the other."""
    kept = lambda kind, *cols: F.struct(F.lit(kind).cast("byte").alias("kind"), *[x.alias(n) for n, x in zip(_COLUMNS, cols, strict=True)])
    doc, lo, hi, before, after = (F.col(x) for x in ("doc", "lo", "hi", "before", "after"))
    unknown = F.lit(None).cast("boolean")
    if c == 0:
        children = F.array(kept(_EQUAL, F.col("key"), F.col("mark"), unknown, doc, lo, hi, before, after))
    else:
        half = c // 2
        need = c - half
        h = lambda side, text: (F.xxhash64("key", "mark", F.lit(side), text), F.xxhash64(F.lit(side), text, "mark", "key"))
        head, rest = (lambda t: F.substring(t, 1, need)), (lambda t: F.substring(t, need + 1, half))
        # at most `half` characters before, so at least `need` after; or the other way round. Both then lack `half`
        right = kept(_DEEPER, *h(1, head(after)), unknown, doc, lo, hi + need, F.substring(before, 1, half), rest(after))
        left = kept(_DEEPER, *h(0, head(before)), unknown, doc, lo - need, hi, rest(before), F.substring(after, 1, half))
        children = F.array_compact(F.array(F.when(F.length(after) >= need, right), F.when(F.length(before) >= need, left)))
    return rows.select(F.explode(children).alias("x")).select("x.kind", F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"), *[f"x.{n}" for n in _COLUMNS])


def _small_batches(c: int, cover: bool):
    """Streams occurrences sorted by group, all of them small; never holds more than a batch and
    one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def fresh(t: pa.Table) -> np.ndarray:
            key, mark = t.column("key").to_numpy(), t.column("mark").to_numpy()
            return np.concatenate([[True], (key[1:] != key[:-1]) | (mark[1:] != mark[:-1])])

        def done(t: pa.Table) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(fresh(t))
            sizes = np.diff(np.append(starts, t.num_rows))
            if (sizes > 1).any():
                yield from _direct(t, starts[sizes > 1], sizes[sizes > 1], c, cover)

        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([kept, t]).combine_chunks() if kept is not None else t
            if not t.num_rows:
                continue
            last = int(np.flatnonzero(fresh(t))[-1])
            if last:
                yield from done(t.slice(0, last).combine_chunks())
            kept = t.slice(last)
        if kept is not None and kept.num_rows:
            yield from done(kept.combine_chunks())

    return run


def _level(rows: DataFrame, c: int, direct: int, cover: bool) -> DataFrame:
    """One level: pairs and covers of the small groups, and what becomes of the large ones."""
    small = rows.filter(~F.col("large")).repartition("key", "mark").sortWithinPartitions("key", "mark")
    return small.mapInArrow(_small_batches(c, cover), _OUT).unionByName(_split(rows.filter("large"), c))


def _sized(rows: DataFrame, direct: int) -> DataFrame:
    """`rows` whose group stands in more than one document, marked large or small. The sizes are
    partial counts; the join back splits hot groups between tasks."""
    sizes = rows.groupBy("key", "mark").agg(F.count("*").alias("n"), F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    return rows.drop("large").join(sizes, ["key", "mark"]).withColumn("large", F.col("n") > direct).select(*_COLUMNS)


def _common(single: DataFrame, documents: int, k: int, need: int) -> DataFrame:
    """Keys of anchors that stand in many documents of a sample: at most SAMPLE documents' anchors
    over COMMON rows. They are repeated for certain; which keys are known beforehand decides only
    the way they take."""
    part = F.pmod(F.xxhash64(F.lit(11), "doc"), F.lit(max(1, documents // SAMPLE))) == 0
    seen = single.filter(part).mapInArrow(_anchor_batches(k, need), "key long, doc long, pos int")
    return seen.groupBy("key").agg(F.count_distinct("doc").alias("n")).filter(F.col("n") >= COMMON).select("key")


def copies(docs: DataFrame) -> DataFrame:
    """(doc, rep, chars): the documents whose whole text occurs more than once, with the least id
    that has it. Texts are told apart by two independent 64-bit hashes and their length."""
    marks = ["h1", "h2", "chars"]
    own = docs.select("doc", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), F.col("text")).alias("h2"), F.length("text").alias("chars"))
    many = own.groupBy(*marks).agg(F.min("doc").alias("rep"), F.max("doc").alias("last")).filter("rep < last").drop("last")
    return own.join(many, marks).select("doc", "rep", "chars").distinct()


def shared_spans(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", need: int = MIN_CHARS, cover: bool = False, direct: int = DIRECT) -> dict[str, DataFrame]:
    """Documents with a span of at least `need` characters (code points) in common.

    Returns `pairs` (a < b), between representatives of equal texts; `groups` (key, mark, doc):
    representatives that all hold one window of `need` characters, where they are too many to be
    compared one by one; `members` (doc, rep, chars) of texts that occur more than once; with
    `cover`, also `spans` (doc, lo, hi): parts of a representative that stand in another text.
    Every pair of different texts with such a span is among the pairs or in a group (`linked`
    lists them all), and every such span lies in the union of `spans`.

    Null ids and texts, and texts shorter than `need`, share nothing; repeated rows count once;
    an empty table gives empty results. Texts of any length are worked on whole, in overlapping
    pieces."""
    k = max(1, need // 2)
    docs = documents.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).filter(F.col("doc").isNotNull() & (F.length("text") >= need))
    members = written(copies(docs), "copies")
    spare = bounded(members.filter("doc <> rep").select("doc"), 1_000_000)
    single = docs.join(spare, "doc", "left_anti")
    common = F.broadcast(written(_common(single, documents.count(), k, need), "common").withColumn("common", F.lit(True)))
    anchors = single.mapInArrow(_anchor_batches(k, need), "key long, doc long, pos int").join(common, "key", "left")
    known = F.coalesce("common", F.lit(False))
    of_key = Window.partitionBy("key", F.when(known, F.col("doc")))  # rows of common keys are not gathered
    repeated = (
        anchors.select("key", "doc", "pos", known.alias("common"), F.count("*").over(of_key).alias("n"), F.min("doc").over(of_key).alias("first"), F.max("doc").over(of_key).alias("last"))
        .filter("common or first < last").select("doc", F.struct("key", "pos", (F.col("common") | (F.col("n") > direct)).alias("large")).alias("spot"))
    )
    spots = repeated.groupBy("doc").agg(F.collect_list("spot").alias("spots"))
    rows = single.join(spots, "doc").select("doc", "text", "spots").mapInArrow(_context_batches(k, need), _ROW)
    missing, results = need - k, []
    while True:
        found = written(_level(rows, missing, direct, cover), f"level{missing}")
        results.append(found)
        deeper = found.filter(f"kind = {_DEEPER}").select(*_COLUMNS)
        if missing == 0 or deeper.isEmpty():
            break
        rows, missing = _sized(deeper, direct), missing // 2
    every = results[0]
    for r in results[1:]:
        every = every.unionByName(r)
    equal = results[-1].filter(f"kind = {_EQUAL}").select("key", "mark", "doc", "lo", "hi")
    out = {"pairs": every.filter(f"kind = {_PAIR}").select("a", "b").distinct(), "groups": _chosen(equal.select("key", "mark", "doc").distinct()), "members": members}
    if cover:
        out["spans"] = every.filter(f"kind = {_COVER}").select("doc", "lo", "hi").unionByName(equal.select("doc", "lo", "hi"))
    return out


def _chosen(equal: DataFrame) -> DataFrame:
    """(key, mark, doc): of the groups with the same documents, one."""
    sum_of = lambda *cols: F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))
    sets = equal.groupBy("key", "mark").agg(F.count("*").alias("n"), sum_of("doc").alias("s1"), sum_of(F.lit(3), "doc").alias("s2"))
    one = sets.filter("n > 1").groupBy("n", "s1", "s2").agg(F.min(F.struct("key", "mark")).alias("m")).select("m.key", "m.mark")
    return equal.join(one, ["key", "mark"])


def linked(got: dict[str, DataFrame]) -> DataFrame:
    """(a, b), a < b: all pairs of different texts from the result of `shared_spans`, the groups'
    included."""
    g = got["groups"]
    within = g.withColumnRenamed("doc", "a").join(g.withColumnRenamed("doc", "b"), ["key", "mark"]).filter("a < b").select("a", "b")
    return got["pairs"].unionByName(within).distinct()


def expand(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of documents (a < b) from pairs of representatives, copies included."""
    m = members.select(F.col("rep"), F.col("doc"))
    full = pairs.join(m.select(F.col("rep").alias("a"), F.col("doc").alias("x")), "a", "left").join(m.select(F.col("rep").alias("b"), F.col("doc").alias("y")), "b", "left")
    x, y = F.coalesce("x", "a"), F.coalesce("y", "b")
    across = full.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    within = m.withColumnRenamed("doc", "a").join(m.withColumnRenamed("doc", "b"), "rep").filter("a < b").select("a", "b")
    return across.unionByName(within)


def shared_share(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", need: int = MIN_CHARS, direct: int = DIRECT) -> DataFrame:
    """(doc_id, chars, shared_chars, share): how much of each document lies in spans of at least
    `need` characters that stand elsewhere. One row per document with a text, also without any."""
    got = shared_spans(documents, doc_id=doc_id, text=text, need=need, cover=True, direct=direct)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = []
            for spans in b.column("spans").to_pylist():
                x = np.array(sorted((s["lo"], s["hi"]) for s in spans), dtype=np.int64)
                reach = np.concatenate([[-1], np.maximum.accumulate(x[:, 1])[:-1]])
                total.append(int(np.maximum(0, x[:, 1] - np.maximum(x[:, 0], reach)).sum()))
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(total, pa.int64())], names=["doc", "shared"])

    per = got["spans"].distinct().groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")).mapInArrow(merge, "doc long, shared long")
    base = documents.select(F.col(doc_id).cast("long").alias("doc"), F.length(text).cast("long").alias("chars")).filter("doc is not null and chars is not null").distinct()
    whole = got["members"].select("doc", F.lit(True).alias("whole"))
    return base.join(per, "doc", "left").join(whole, "doc", "left").select(
        F.col("doc").alias("doc_id"), "chars",
        F.when(F.col("whole"), F.col("chars")).otherwise(F.coalesce("shared", F.lit(0))).cast("long").alias("shared_chars"),
    ).withColumn("share", F.when(F.col("chars") > 0, F.col("shared_chars") / F.col("chars")).otherwise(F.lit(0.0)))
