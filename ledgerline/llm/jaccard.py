"""N-gram Jaccard join by T-occurrence search over inverted lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise
from .components import connected_components
from .repeats import Rolling, _gather, _mix

SHINGLE = 5
#: Documents link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Inverted lists up to this length are short: all their pairs are candidates at once.
SHORT = 8
#: Hubs that members of a long list are held against first, and members of a part of it.
HUBS = 3
BLOCK = 1024
#: Members of a long list in one range of sizes that are compared by their first common token alone;
#: beyond that the second common token splits them.
CROWD = 20_000
#: Rows of one list that a task holds at once; what a list has beyond them counts as long.
LONGEST = 1_000_000
#: Smallest tokens of a set by which two sets are known to have met in an earlier list.
HEADS = 4
#: Members checked against one text together.
CHUNK = 256
#: Set hashes a worker remembers, so that copies within a task give their postings once.
SEEN = 1_000_000
_U = np.uint64


def shingle_sets(texts: list[str | None], shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z count as a-z; few words make one shingle."""
    for _, words, ends in _gather([t and t.translate(_LOWER) for t in texts]):
        rolling, at = Rolling(words), 0
        for end in ends.tolist():
            n = end - at
            if n >= shingle:
                yield np.unique(rolling.stretch(np.arange(at, end - shingle + 1), shingle))
            else:
                yield rolling.stretch(np.array([at]), n) if n else np.empty(0, _U)
            at = end


_LOWER = {i: i + 32 for i in range(65, 91)}


def least_overlap(n, percent: int = PERCENT):
    """T: shingles that a set of ``n`` shares with any partner at least."""
    return (percent * n + 99) // 100


def parity(tokens: np.ndarray) -> bytes:
    """Parity of the tokens of each hash class, a bit each, as many as a power of two from len(tokens) on.

    Bits that differ between two sets are at most the tokens that only one has;
    halves xored give the bitmap of half the classes.
    """
    bits = max(256, 1 << (max(1, len(tokens)) - 1).bit_length())
    at = (_mix(tokens) & _U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _pick() -> Column:
    """Names a row's text: a doc may be null or stand for several texts."""
    return F.xxhash64("doc", "text")


def signatures(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(doc, pick, node, n, prefix, bits): set hash and size of every document, and for the first with
    that hash in its task the n - T + 2 smallest tokens: any partner shares one of all but the last of them, and two of
    them if it shares two tokens at all. ``pick`` (a hash
    of doc and text) finds the row's text again."""
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("pick", T.LongType()), T.StructField("node", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            docs_, picks, nodes, sizes, prefixes, bits = batch.column("doc"), batch.column("pick"), [], [], [], []
            for tokens in shingle_sets(batch.column("text").to_pylist(), shingle):
                n = len(tokens)
                node = xxhash.xxh3_64_intdigest(tokens.tobytes(), n)
                new = n > 0 and node not in seen
                if new:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                nodes.append(node)
                sizes.append(n)
                prefixes.append(tokens[: n - least_overlap(n, percent) + 2] if new else tokens[:0])
                bits.append(parity(tokens) if new else None)
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([docs_.cast(pa.int64()), picks, pa.array(np.array(nodes, _U).view(np.int64)), pa.array(sizes, pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(bits, pa.binary())],
                                             names=[f.name for f in schema])

    return docs.select("doc", _pick().alias("pick"), "text").mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 0) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows with equal ``keys`` stay together (input sorted by them), but for
    pieces of ``most`` rows or more with the same keys, if that is given."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            x = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= x[1:] != x[:-1]
            if held:
                change[0] |= x[0] != held[-1].column(k)[-1].as_py()
        at = np.flatnonzero(change)
        if not len(at):
            held.append(batch)
            if most and sum(b.num_rows for b in held) >= most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            continue
        if held or at[0]:
            if at[0]:
                held.append(batch.slice(0, at[0]))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        if at[-1] > at[0]:
            yield batch.slice(at[0], at[-1] - at[0])
        held = [batch.slice(at[-1])]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _grouped(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*[F.col(k) for k in keys[:1]]).sortWithinPartitions(*keys)


def shared_lists(postings: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(token, node, n, size) of the inverted lists that hold two different sets or more, of sizes that may link."""
    schema = "token long, node long, n long, size long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = None  # the token of the last piece of a list that came in several
        for batch in _runs(batches, ["token"], LONGEST):
            token, node, n = (batch.column(c).to_numpy() for c in ("token", "node", "n"))
            if len(token) >= LONGEST and token[0] == token[-1]:
                cut = token[0]
            first = np.r_[True, (token[1:] != token[:-1]) | (node[1:] != node[:-1])]
            token, node, n = token[first], node[first], n[first]
            # By size within a list: whoever has a partner at all has one next to it.
            order = np.lexsort((n, token))
            token, node, n = token[order], node[order], n[order]
            close = (token[1:] == token[:-1]) & (100 * n[:-1] >= percent * n[1:])
            kept = np.r_[False, close] | np.r_[close, False]
            if cut is not None:
                kept |= token == cut
            token, node, n = token[kept], node[kept], n[kept]
            if len(token):
                start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
                size = np.diff(np.r_[start, len(token)])
                size = np.where(token == cut, LONGEST, np.repeat(size, size)) if cut is not None else np.repeat(size, size)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (token, node, n, size)], names=["token", "node", "n", "size"])

    return _grouped(postings, "token", "node").mapInArrow(run, schema)


class Lists:
    """Members of one list with sizes and bitmaps; finds the pairs that may link."""

    def __init__(self, n: np.ndarray, bits: list[bytes], percent: int):
        self.n, self.percent = n, percent
        self.width = np.array([len(b) for b in bits])
        self.maps = {}
        for w in np.unique(self.width):
            own = np.flatnonzero(self.width == w)
            self.maps[int(w)] = (own, np.frombuffer(b"".join(bits[i] for i in own), _U).reshape(len(own), -1))

    def _folded(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Members whose bitmap has ``width`` bytes or twice that, folded to ``width``."""
        own, maps = self.maps[width]
        if 2 * width in self.maps:
            more, wide = self.maps[2 * width]
            own, maps = np.r_[own, more], np.r_[maps, wide[:, : width // 8] ^ wide[:, width // 8 :]]
        return own, maps

    def pairs(self, left: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places within the bounds on size and difference, each once; with ``left``, those with a marked member."""
        for width in self.maps:
            own, maps = self._folded(width)
            n = self.n[own]
            native = self.width[own] == width
            rows = np.flatnonzero(left[own]) if left is not None else np.arange(len(own))
            for a in range(0, len(rows), 64):
                r = rows[a : a + 64]
                lo, hi = np.minimum(n[r, None], n[None]), np.maximum(n[r, None], n[None])
                ok = (100 * lo >= self.percent * hi) & (native[r, None] | native[None])
                both = left[own][None] if left is not None else True
                ok &= (r[:, None] < np.arange(len(own))[None]) | ~np.broadcast_to(both, ok.shape)
                ok &= own[r][:, None] != own[None]
                i, j = np.nonzero(ok)
                for b in range(0, len(i), 200_000):
                    x, y = r[i[b : b + 200_000]], j[b : b + 200_000]
                    apart = np.bitwise_count(maps[x] ^ maps[y]).sum(axis=1, dtype=np.int64)
                    near = (100 + self.percent) * apart <= (100 - self.percent) * (n[x] + n[y])
                    yield own[x[near]], own[y[near]]


def _emit(node: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]], keep=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x, y in pairs:
        if keep is not None and len(x):
            ok = keep(x, y)
            x, y = x[ok], y[ok]
        if len(x):
            yield np.minimum(node[x], node[y]), np.maximum(node[x], node[y])


def _met(token: np.ndarray, heads_x: np.ndarray, heads_y: np.ndarray) -> np.ndarray:
    """Whether pairs in the lists of ``token`` have met in the list of a smaller token that is among the
    smallest ones (a row of heads each) of both."""
    met, key = np.zeros(len(heads_x), bool), token.view(_U)
    for i in range(heads_x.shape[1]):
        for j in range(max(0, i - 1), min(heads_x.shape[1], i + 2)):
            met |= (heads_x[:, i] == heads_y[:, j]) & (heads_x[:, i] < key)
    return met


def _unmet(token: int, heads: np.ndarray):
    """``_met`` for places in one list, negated."""
    return lambda x, y: ~_met(np.full(len(x), token, np.int64), heads[x], heads[y])


def _heads(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(f"t{i}").to_numpy().view(_U) for i in range(HEADS)], axis=1)


class Bitmaps:
    """Bitmaps of the rows of a batch, read where they lie."""

    def __init__(self, column: pa.Array):
        column = column if isinstance(column, pa.BinaryArray) else column.cast(pa.binary())
        at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        self.start, self.width = at[:-1], np.diff(at)
        self.data = np.frombuffer(column.buffers()[2], np.uint8)

    def _rows(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps of rows of ``width`` bytes, or of twice that folded to it."""
        own = int(self.width[rows[0]])
        maps = self.data[self.start[rows][:, None] + np.arange(own)].view(_U)
        return maps if own == width else maps[:, : width // 8] ^ maps[:, width // 8 :]

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Differing bits of pairs of rows whose sizes are within the bound (widths equal or twice)."""
        out = np.zeros(len(x), np.int64)
        kinds = self.width[x] * (1 << 32) + self.width[y]
        for kind in np.unique(kinds):
            at = np.flatnonzero(kinds == kind)
            width = int(min(kind >> 32, kind & 0xFFFFFFFF))
            for part in np.array_split(at, max(1, len(at) * width // 16_000_000)):
                out[part] = np.bitwise_count(self._rows(x[part], width) ^ self._rows(y[part], width)).sum(axis=1, dtype=np.int64)
        return out


def _short_pairs(batch: pa.RecordBatch, start: np.ndarray, length: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes that may link from short lists (places ``start``, ``length`` members each), all lists of a length at once."""
    token, node, n = (batch.column(c).to_numpy() for c in ("token", "node", "n"))
    heads, maps = _heads(batch), Bitmaps(batch.column("bits"))
    for members in np.unique(length):
        i, j = np.triu_indices(int(members), 1)
        first = start[length == members][:, None]
        x, y = (first + i).ravel(), (first + j).ravel()
        lo, hi = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
        ok = (100 * lo >= percent * hi) & (node[x] != node[y])
        x, y = x[ok], y[ok]
        ok = ~_met(token[x], heads[x], heads[y])
        x, y = x[ok], y[ok]
        ok = (100 + percent) * maps.apart(x, y) <= (100 - percent) * (n[x] + n[y])
        yield np.minimum(node[x[ok]], node[y[ok]]), np.maximum(node[x[ok]], node[y[ok]])


def first_candidates(lists: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(x, y) that may link, from lists (token, node, n, size, t0.., bits): all pairs of short lists, and
    of long ones each member with a few hubs, much the same ones in all lists
    (very long lists in parts, each with its hubs). A pair of a
    short list that two sets' smallest tokens show to have met in an earlier list is left to that one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches, ["token", "part"]):
            token, part, node, n = (batch.column(c).to_numpy() for c in ("token", "part", "node", "n"))
            size, bits = batch.column("size").to_numpy(), None
            start = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (part[1:] != part[:-1])])
            length = np.diff(np.r_[start, len(token)])
            few = (size[start] <= SHORT) & (length > 1)
            out = list(_short_pairs(batch, start[few], length[few], percent)) if few.any() else []
            for a, b in zip(start[size[start] > SHORT], (start + length)[size[start] > SHORT], strict=True):
                bits = batch.column("bits").to_pylist() if bits is None else bits
                hubs = np.zeros(b - a, bool)
                hubs[np.argsort(_mix(node[a:b].view(_U) + _U(token[a] & 1)))[:HUBS]] = True
                out += _emit(node[a:b], Lists(n[a:b], bits[a:b], percent).pairs(hubs))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["x", "y"])

    parts = F.ceil(F.col("size") / (8 * BLOCK))
    dealt = lists.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    return dealt.repartition("token", "part").sortWithinPartitions("token", "part", "node").mapInArrow(run, "x long, y long").distinct()


def size_range(n: Column, percent: int = PERCENT) -> Column:
    """Ranges of set sizes, a little wider than the bound on sizes that may link, so that only sets in
    the same or in neighbouring ranges do."""
    return F.floor(F.log(n.cast("double")) / math.log(1.01 * 100 / percent)).cast("int")


def late_candidates(lists: DataFrame, known: DataFrame, tokens: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(x, y) of different components that may link, from long lists (token, node, n, component) and what is
    ``known`` of the nodes (k, t0.., bits), which only rows that have someone to meet carry along.

    A list is cut by size: a member stands in its own range and, to meet smaller ones,
    in none but the next, so rows grow with the list and not with its square. Where a
    range still holds a crowd, sets that link also share a second one of their first
    n - T + 2 tokens (``tokens``: node, more), so each member is posted under its later
    ones and meets only those that share one of them.
    """
    own = size_range(F.col("n"), percent)
    dealt = lists.withColumn("own", own).withColumn("range", F.explode(F.array(own, own + 1)))
    ranges = materialise(dealt.select("token", "range", (F.col("own") == F.col("range")).alias("native"), "node", "n", "component"), "jaccard_ranges")
    held = ranges.groupBy(F.col("token").alias("c"), F.col("range").alias("r")).agg(
        F.count("*").alias("held"), F.max("native").alias("any"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    held = materialise(held.where("held > 1 and any and lo < hi").select("c", "r", (F.col("held") > CROWD).alias("crowd")), "jaccard_held")
    dealt = ranges.join(held, (F.col("token") == F.col("c")) & (F.col("range") == F.col("r"))).drop("c", "r")
    later = F.filter("more", lambda t: unsigned(t) > unsigned(F.col("token")))
    crowds = (dealt.where("crowd").join(tokens.withColumnRenamed("node", "m"), F.col("node") == F.col("m"))
              .withColumn("second", F.explode(later)).drop("m", "more"))
    dealt = dealt.where("not crowd").withColumn("second", F.lit(0).cast("long")).unionByName(crowds).drop("crowd")
    dealt = dealt.join(known, F.col("node") == F.col("k")).drop("k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches, ["token", "range", "second"]):
            token, range_, second, node, n, comp = (batch.column(c).to_numpy() for c in ("token", "range", "second", "node", "n", "component"))
            native = batch.column("native").to_numpy(zero_copy_only=False)
            bits, heads = batch.column("bits").to_pylist(), _heads(batch)
            start = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (range_[1:] != range_[:-1]) | (second[1:] != second[:-1])])
            out = []
            for a, b in zip(start, np.r_[start[1:], len(token)], strict=True):
                c, own = comp[a:b], native[a:b]
                kinds, at, members = np.unique(c, return_inverse=True, return_counts=True)
                if len(kinds) == 1 or not own.any():
                    continue
                # Whoever meets another component is outside of the largest one, or meets one who is.
                outside = at != members.argmax()
                unmet = _unmet(token[a], heads[a:b])
                out += _emit(node[a:b], Lists(n[a:b], bits[a:b], percent).pairs(outside),
                             lambda x, y, c=c, own=own, unmet=unmet: (c[x] != c[y]) & (own[x] | own[y]) & unmet(x, y))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["x", "y"])

    keyed = dealt.repartition("token", "range", "second").sortWithinPartitions("token", "range", "second", "node")
    found = materialise(keyed.mapInArrow(run, "x long, y long").distinct(), "jaccard_late")
    discard(ranges, held)
    return found


def unsigned(token: Column) -> Column:
    """Sorts a token as the unsigned number it is (Spark's longs are signed)."""
    return token.bitwiseXOR(F.lit(-(1 << 63)))


def t_occurrence(query: np.ndarray, members: list[np.ndarray], least: int) -> np.ndarray:
    """Shingles that each member shares with ``query`` (0 for members below ``least``).

    DivideSkip: of the query's inverted lists over the members, the longest (up to
    ``least`` - 1) are set aside; the short ones are merged and counted, and only
    members with enough hits are looked up in the long lists by binary search.
    """
    owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
    tokens = np.concatenate(members) if members else np.empty(0, _U)
    at = np.searchsorted(query, tokens)
    hit = query[np.minimum(at, len(query) - 1)] == tokens
    at, owner = at[hit], owner[hit]
    length = np.bincount(at, minlength=len(query))
    skip = min(max(0, least - 1), int((length > len(members) // 2).sum()))
    order = np.argsort(-length, kind="stable")
    long_ = np.zeros(len(query), bool)
    long_[order[:skip]] = True
    count = np.bincount(owner[~long_[at]], minlength=len(members))
    enough = np.flatnonzero(count >= least - skip)
    probes = np.sort(query[long_])
    for i in enough if skip else []:
        place = np.searchsorted(members[i], probes)
        count[i] += (members[i][np.minimum(place, len(members[i]) - 1)] == probes).sum()
    out = np.zeros(len(members), np.int64)
    out[enough] = count[enough]
    return np.where(out >= least, out, 0)


def verify(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(u, v) of the pairs (x, y) that link, by whole texts (node, text), as a written table. Partners of a text are
    checked in chunks, so a text with many partners is spread."""
    written = materialise(pairs, "jaccard_pairs")
    many = written.groupBy(F.col("x").alias("q")).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = written.join(many, F.col("x") == F.col("q")).select("x", F.pmod(F.xxhash64("y"), F.col("chunks")).cast("int").alias("chunk"), "y")
    dealt = materialise(dealt, "jaccard_chunks")
    rows = dealt.select("x", "chunk", F.col("y").alias("m")).unionByName(dealt.select("x", "chunk", F.col("x").alias("m")).distinct())
    rows = rows.join(texts.hint("merge"), F.col("m") == F.col("node")).select("x", "chunk", (F.col("m") != F.col("x")).alias("member"), "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches, ["x", "chunk"]):
            x, chunk, member, node = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "chunk", "member", "node"))
            start = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (chunk[1:] != chunk[:-1])])
            us, vs = [], []
            for a, b in zip(start, np.r_[start[1:], len(x)], strict=True):
                sets = list(shingle_sets(batch.column("text").slice(a, b - a).to_pylist(), shingle))
                query, others = sets[0], sets[1:]  # the query's own row sorts first
                if member[a] or not others:
                    continue
                shared = t_occurrence(query, others, int(least_overlap(len(query), percent)))
                union = len(query) + np.array([len(s) for s in others]) - shared
                ok = (shared > 0) & (100 * shared >= percent * union)
                vs.append(node[a + 1 : b][ok])
                us.append(np.full(ok.sum(), x[a]))
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    out = materialise(rows.repartition("x", "chunk").sortWithinPartitions("x", "chunk", "member").mapInArrow(run, "u long, v long"), "jaccard_links")
    discard(written, dealt)
    return out


def jaccard_components(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(doc, node, n, component) for every row of ``docs`` (doc long, text).

    Two documents link when their sets of ``shingle``-word shingles have
    100 * intersection >= ``percent`` * union; component is the smallest doc
    that links reach. Equal sets are one node. A node posts its n - T + 1
    smallest tokens (T: the overlap any partner must reach); nodes that share no
    posted token cannot link. Pairs within a list pass bounds on size and on
    differing bits before whole texts decide. Short lists give all pairs. A long
    list first ties its members to hubs; what then still lies in different
    components is compared block by block, so no link is lost, and a group of
    near copies is not expanded into all its pairs.
    So the result is components, not the join's pairs or their number: pairs already
    in one component are not compared.
    """
    sets = materialise(signatures(docs, percent, shingle), "jaccard_sets")
    first_of = sets.where("bits is not null")
    posted = F.slice("prefix", 1, (F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1).cast("int"))
    postings = first_of.select(F.explode(posted).alias("token"), "node", "n")
    lists = materialise(shared_lists(postings, percent), "jaccard_lists")
    wanted = lists.groupBy("node").agg(F.count("*").alias("posts")).withColumnRenamed("node", "w")
    heads = [f"t{i}" for i in range(HEADS)]
    rep = (first_of.groupBy("node").agg(F.min(F.struct("doc", "pick", "bits", "prefix", *[F.coalesce(F.get(posted, F.lit(i)), "node").alias(t) for i, t in enumerate(heads)])).alias("r"))
           .join(wanted, F.col("node") == F.col("w"), "left_semi").select("node", "r.*"))
    rep = materialise(rep, "jaccard_nodes")
    known = rep.select(F.col("node").alias("k"), "bits", *heads)
    first = materialise(first_candidates(lists.join(known, F.col("node") == F.col("k")).drop("k"), percent), "jaccard_first")
    long_ = lists.where(F.col("size") > SHORT)

    nodes = first.select(F.explode(F.array("x", "y")).alias("c")).unionByName(long_.select(F.col("node").alias("c"))).distinct()
    held = rep.select("node", F.col("pick").alias("p")).join(nodes, F.col("node") == F.col("c"), "left_semi")
    texts = docs.select(_pick().alias("pick"), "text").join(held.hint("merge"), F.col("pick") == F.col("p"))
    # Rows with the same doc and text have the same pick: one of them stands for the node.
    texts = materialise(texts.dropDuplicates(["pick"]).select("node", "text"), "jaccard_texts")
    links = verify(first, texts, percent, shingle)
    groups = materialise(connected_components(links), "jaccard_groups")

    late = long_.join(groups.withColumnRenamed("node", "g"), F.col("node") == F.col("g"), "left").select("token", "node", "n", F.coalesce("component", "node").alias("component"))
    late = materialise(late, "jaccard_long")
    discard(lists)
    split = late.groupBy(F.col("token").alias("s")).agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("s")
    apart = late.join(split, F.col("token") == F.col("s")).drop("s")
    tokens = rep.select("node", F.col("prefix").alias("more"))
    second = late_candidates(apart, known, tokens, percent).join(first.select(F.col("x").alias("fx"), F.col("y").alias("fy")), (F.col("x") == F.col("fx")) & (F.col("y") == F.col("fy")), "left_anti")
    more = verify(second, texts, percent, shingle)
    if not more.isEmpty():
        groups = materialise(connected_components(links.unionByName(more)), "jaccard_groups")
    discard(rep, first, texts, links, more, late)

    members = sets.select("doc", "node", "n").join(groups.withColumnRenamed("node", "g"), F.col("node") == F.col("g"), "left")
    members = materialise(members.select("doc", "node", "n", F.when(F.col("n") > 0, F.coalesce("component", "node")).alias("group")), "jaccard_members")
    discard(sets, groups)
    least = materialise(members.where("group is not null and doc is not null").groupBy(F.col("group").alias("l")).agg(F.min("doc").alias("least")), "jaccard_least")
    return (members.join(least, F.col("group") == F.col("l"), "left")
            .select("doc", "node", "n", F.when(F.col("doc").isNotNull(), F.coalesce("least", "doc")).alias("component")))


def one_of_each_group(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` (doc_id, text, other columns) with one document of each group that links connect: the smallest doc_id.

    Defined cases: blank and null texts link with nothing and stay; a null doc_id
    is no document that another could stand for, so its row stays; of rows with
    the same doc_id and text one stays; an empty table stays empty.
    """
    found = jaccard_components(docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), percent, shingle)
    found = found.where("doc is not null").groupBy(F.col("doc").alias("__doc"), F.col("node").alias("__node")).agg(F.min("component").alias("__component"), F.count("*").alias("__rows"))
    found = found.groupBy("__doc").agg(F.max(F.col("__doc") == F.col("__component")).alias("__stays"), F.max("__rows").alias("__rows"))
    found = materialise(found, "jaccard_decisions")
    kept = docs.join(found.hint("merge"), docs["doc_id"].cast("long") == F.col("__doc"), "left").where("__doc is null or __stays")
    if found.where("__stays and __rows > 1").isEmpty():
        return kept.select(*[docs[f"`{c}`"] for c in docs.columns])
    once = kept.where("coalesce(__rows, 1) = 1").select(*[docs[f"`{c}`"] for c in docs.columns])
    return once.unionByName(kept.where("__rows > 1").select(*[docs[f"`{c}`"] for c in docs.columns]).dropDuplicates(["doc_id", "text"]))
