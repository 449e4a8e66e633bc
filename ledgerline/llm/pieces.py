"""Piece encoding with seeded merge dropout, and lossless decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import shipped

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a space in pieces
#: Units up to this many symbols are merged in arrays, longer ones with an agenda of their own.
ARRAY_SYMBOLS = 32
#: Characters of texts handled at once, and cuts that a worker keeps (a cut: a unit and the merges skipped in it).
SLICE_CHARS = 1_000_000
CACHE_UNITS = 300_000
#: Stretches of a text that no piece crosses: always at spaces and line ends, and between letters
#: and other characters if the vocabulary has no piece of both.
_UNIT = re.compile(r" *[^ \n]+| +|\n")
_FINE_UNIT = re.compile(r" *[^\W\d_]+| *(?:[\W\d_](?<![ \n]))+| +|\n")
_MIXED = re.compile(r"[^\W\d_][\W\d_]|[\W\d_][^\W\d_]")
_ODD = 1 << 19  # stand-ins for characters without a piece lie above
_NEVER = np.iinfo(np.int32).max
_M64 = (1 << 64) - 1
_K1, _K2, _K3 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


class PieceTable:
    """Pieces of a model as plain tables; small and fixed in size, so it is broadcast."""

    def __init__(self, model_proto: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model_proto)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        ids = {sp.id_to_piece(i): i for i in plain}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.of_code = np.zeros(0x110000, np.int32)  # id of each code point's piece, 0 for none
        for p, i in ids.items():
            if len(p) == 1:
                self.of_code[ord(p)] = i
        self.of_code[ord(" ")], self.of_code[ord(MARK)] = self.of_code[ord(MARK)], 0
        self.bytes_of = [b""] * n
        for p, i in ids.items():
            self.bytes_of[i] = p.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([b])
        self.unit = _UNIT if any(_MIXED.search(p.lstrip(MARK)) for p in ids) else _FINE_UNIT
        rank_of = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        pairs = {}
        for p, i in ids.items():
            for k in range(1, len(p)):
                left, right = ids.get(p[:k]), ids.get(p[k:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = (rank_of[sp.get_score(i)], i)
        self.pairs = pairs
        keys = sorted(pairs)
        self.keys = np.array([-1, *keys], np.int64)
        self.ranks = np.array([_NEVER, *(pairs[k][0] for k in keys)], np.int32)
        self.merged = np.array([0, *(pairs[k][1] for k in keys)], np.int32)
        self.slots = np.zeros(max(1 << 19, 1 << (4 * len(keys)).bit_length()), np.int32)  # open addressing
        self.shift = np.uint64(65 - len(self.slots).bit_length())
        for at, slot in enumerate(self._slot(self.keys[1:]).tolist(), 1):
            while self.slots[slot]:
                slot = slot + 1 & len(self.slots) - 1
            self.slots[slot] = at

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(_K1) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in ``ranks`` and ``merged``; 0 where the pair has no merge."""
        key = left.astype(np.int64) << 20 | right
        slot = self._slot(key)
        at = self.slots[slot]
        open_ = np.flatnonzero((at > 0) & (self.keys[at] != key))
        while len(open_):
            slot[open_] = slot[open_] + 1 & len(self.slots) - 1
            at[open_] = self.slots[slot[open_]]
            open_ = open_[(at[open_] > 0) & (self.keys[at[open_]] != key[open_])]
        return at


def _unit_key(text: str, seed: int, stream: int) -> int:
    return (xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed & _M64) + stream * _K3) & _M64


def place_keys(key: int, places: np.ndarray) -> np.ndarray:
    """Keys of the units at the given places of the text with ``key``."""
    x = np.uint64(key) + places.astype(np.uint64) * np.uint64(_K1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _skips(key, a, b, c, limit: int):
    """Whether the merge of [a, b) and [b, c) is skipped: a hash of unit key and borders, below the limit.

    Works on Python integers and on arrays alike.
    """
    x = (key ^ (a * _K1 + b * _K2 + c * _K3)) & _M64
    x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & _M64
    x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & _M64
    return (x >> 33) < limit


def _borders(a, b, c):
    """The part of ``_skips`` that depends on the borders, for arrays; it also names a merge within its unit."""
    u = np.uint64
    return a.astype(u) * u(_K1) + b.astype(u) * u(_K2) + c.astype(u) * u(_K3)


def _skips_array(key, borders, limit: int):
    u = np.uint64
    x = key ^ borders
    for _ in range(2):
        x = (x ^ (x >> u(32))) * u(0xD6E8FEB86659FD93)
    return (x >> u(33)) < u(limit)


def merge_with_agenda(symbols: list[int], table: PieceTable, key: int, limit: int) -> list[int]:
    """Merge one unit's symbols: best score first, then leftmost; a popped candidate may be skipped."""
    n = len(symbols)
    ids, end = list(symbols), list(range(1, n + 1))
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    agenda: list[tuple[int, int, int, int, int]] = []

    def add(i: int) -> None:
        j = after[i]
        if j != -1 and (hit := table.pairs.get(ids[i] << 20 | ids[j])):
            heapq.heappush(agenda, (hit[0], i, j, end[j], hit[1]))

    for i in range(n - 1):
        add(i)
    while agenda:
        _, i, j, stop, piece = heapq.heappop(agenda)
        if ids[i] < 0 or ids[j] < 0 or after[i] != j or end[j] != stop or end[i] != j:
            continue
        if limit and _skips(key, i, j, stop, limit):
            continue
        ids[i], ids[j], end[i], after[i] = piece, -1, stop, after[j]
        if after[i] != -1:
            before[after[i]] = i
        if before[i] != -1:
            add(before[i])
        add(i)
    return [x for x in ids if x >= 0]


def _merge_rows(ids: np.ndarray, lengths: np.ndarray, table: PieceTable, keys: np.ndarray, limit: int,
                closed: np.ndarray | None = None, made: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The same merges for many short units at once, a row of symbols each: a round makes every
    unit's best merge. Returns the pieces in the rows and their numbers.

    A unit's best open candidate is what its agenda would pop next, and a skipped
    one is closed when it arises, so rounds and agenda give the same pieces.
    ``closed`` has borders of merges that each row skips (0: none); ``made`` gets
    the rows and borders of each round's merges.
    """
    n, width = ids.shape
    w = width + 1
    # Symbols stay at the place of their first character, which is their left border; merged ones become -1.
    ids = np.concatenate([ids.astype(np.int32), np.zeros((n, 1), np.int32)], axis=1)
    rank, open_ = np.full((n, w), _NEVER, np.int32), np.zeros(n * w, np.int32)
    after, before = np.tile(np.arange(1, w + 1), n), np.tile(np.arange(-1, width), n)
    flat, ranks = ids.reshape(-1), rank.reshape(-1)

    def add(r, i, j, c):
        at = table.find(flat[r * w + i], flat[r * w + j])
        if limit or closed is not None:
            borders = _borders(i, j, c)
            if limit:
                at[_skips_array(keys[r], borders, limit)] = 0
            if closed is not None:
                at[(closed[r] == borders[:, None]).any(axis=1)] = 0
        ranks[r * w + i], open_[r * w + i] = table.ranks[at], at

    r, k = np.nonzero(np.arange(1, w) < lengths[:, None])
    if len(r):
        add(r, k, k + 1, k + 2)
    row = np.arange(n)
    while len(row):
        open_rank = rank if len(row) == n else rank[row]
        best = open_rank.argmin(axis=1)
        live = open_rank[np.arange(len(row)), best] != _NEVER
        row, i = row[live], best[live]
        base = row * w
        here = base + i
        j = after[here]
        c = after[base + j]
        if made is not None:
            made.append((row, _borders(i, j, c)))
        flat[here], flat[base + j] = table.merged[open_[here]], -1
        ranks[here], ranks[base + j] = _NEVER, _NEVER
        after[here] = c
        before[base[c < w] + c[c < w]] = i[c < w]
        b = before[here]
        left, right = np.flatnonzero(b >= 0), np.flatnonzero(c < lengths[row])
        if len(left) + len(right):
            b, more = b[left], c[right]
            add(np.r_[row[left], row[right]], np.r_[b, i[right]], np.r_[i[left], more], np.r_[c[left], after[base[right] + more]])
    kept = (ids >= 0) & (np.arange(w) < lengths[:, None])
    sizes = kept.sum(axis=1)
    out = np.zeros((n, width), np.int32)
    out[np.arange(width) < sizes[:, None]] = ids[kept]
    return out, sizes


class Cuts:
    """Cuts of short units, kept by a worker: the plain one, and those with merges skipped.

    A cut has the borders of the merges it makes, in order; ``child`` leads from
    each of them to the cut that skips it as well (-1: not made yet). A cut
    depends on the unit and the skipped merges only, so keeping it limits no choice.
    """

    def __init__(self, table: PieceTable):
        self.table = table
        self.plain: dict[str, int] = {}
        self.ids: list[bytes] = []  # of each cut, 4 bytes to an id
        self.unit: list[str] = []
        self.first, self.count, self.parent, self.root, self.hits = (np.zeros(1024, np.int32) for _ in range(5))
        self.skipped = np.zeros(1024, np.uint64)  # what a cut skips besides what its parent skips
        self.borders, self.child, self.used = np.zeros(4096, np.uint64), np.zeros(4096, np.int32), 0

    def _room(self, cuts: int, merges: int) -> None:
        def longer(x: np.ndarray, n: int) -> np.ndarray:
            return x if n <= len(x) else np.r_[x, np.zeros(max(n, 3 * len(x) // 2) - len(x), x.dtype)]

        for name, n in (("first", cuts), ("count", cuts), ("parent", cuts), ("root", cuts), ("hits", cuts), ("skipped", cuts), ("borders", merges), ("child", merges)):
            setattr(self, name, longer(getattr(self, name), n))

    def add(self, units: list[str], symbols: np.ndarray, parent: np.ndarray, skipped: np.ndarray) -> None:
        """Makes a cut of each unit that skips one merge more than its parent (parent -1: none), in blocks
        of like sizes; ``symbols``: those of all units in a row, 0 for a character without a piece."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        at = np.cumsum(sizes) - sizes
        for a in range(0, len(units), 20_000):
            n = sizes[a : a + 20_000]
            part, k, old = units[a : a + 20_000], len(n), len(self.ids)
            ids = np.zeros((k, int(n.max())), np.int32)
            ids[np.arange(ids.shape[1]) < n[:, None]] = symbols[at[a] : at[a] + n.sum()]
            odd = ((ids == 0) & (np.arange(ids.shape[1]) < n[:, None])).any(axis=1)
            ids[(ids == 0) & (np.arange(ids.shape[1]) < n[:, None])] = _ODD
            up, closed = parent[a : a + 20_000], [skipped[a : a + 20_000]]
            while (up >= 0).any():
                closed.append(np.where(up >= 0, self.skipped[up], np.uint64(0)))
                up = np.where(up >= 0, self.parent[up], -1)
            made: list = []
            none = len(closed) == 1 and not closed[0].any()
            out, size = _merge_rows(ids, n, self.table, np.empty(0, np.uint64), 0, None if none else np.stack(closed, axis=1), made)
            row = np.concatenate([m[0] for m in made]) if made else np.empty(0, np.int64)
            borders = np.concatenate([m[1] for m in made]) if made else np.empty(0, np.uint64)
            count = np.bincount(row, minlength=k)
            self._room(old + k, self.used + len(row))
            self.first[old : old + k] = self.used + np.cumsum(count) - count
            self.count[old : old + k] = count
            self.parent[old : old + k] = parent[a : a + 20_000]
            self.skipped[old : old + k] = skipped[a : a + 20_000]
            self.root[old : old + k] = np.where(parent[a : a + 20_000] >= 0, self.root[parent[a : a + 20_000]], np.arange(old, old + k))
            self.hits[old : old + k] = 0
            self.borders[self.used : self.used + len(row)] = borders[np.argsort(row, kind="stable")]
            self.child[self.used : self.used + len(row)] = -1
            self.used += len(row)
            flat, step = out.tobytes(), 4 * out.shape[1]
            got = [flat[i * step : i * step + 4 * m] for i, m in enumerate(size.tolist())]
            for i in np.flatnonzero(odd):
                got[i] = self.with_bytes(np.frombuffer(got[i], np.int32).tolist(), (ch for ch in part[i] if not self.table.of_code[ord(ch)]))
            self.ids += got
            self.unit += part

    def with_bytes(self, ids: list[int], odd: Iterator[str]) -> bytes:
        """Ids with the bytes of each character without a piece in the place of its stand-in."""
        return np.asarray([x for i in ids for x in ((i,) if i < _ODD else (self.table.byte_ids[b] for b in next(odd).encode("utf-8", "surrogatepass")))], np.int32).tobytes()

    def symbols(self, units: list[str]) -> np.ndarray:
        return self.table.of_code[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)]

    def learn(self, units: list[str]) -> None:
        """Plain cuts of new short units."""
        units.sort(key=len)
        old = len(self.ids)
        self.add(units, self.symbols(units), np.full(len(units), -1, np.int32), np.zeros(len(units), np.uint64))
        self.plain.update(zip(units, range(old, len(self.ids)), strict=True))

    def trim(self, most: int) -> None:
        """Keep the cuts of the units met most often lately, ``most`` cuts at most; the others are made again when met."""
        n = len(self.ids)
        root, hits = self.root[:n], self.hits[:n]
        plain = np.flatnonzero(root == np.arange(n))
        order = plain[np.argsort(-hits[plain], kind="stable")]
        order = order[np.cumsum(np.bincount(root, minlength=n)[order]) <= most]
        hot = np.zeros(n, bool)
        hot[order] = True
        kept = np.flatnonzero(hot[root])
        new = np.full(n + 1, -1, np.int32)  # the last place stands for no cut
        new[kept] = np.arange(len(kept))
        count = self.count[kept]
        at = np.repeat(self.first[kept] - np.cumsum(count) + count, count) + np.arange(count.sum())
        self.borders, self.child = self.borders[at], new[self.child[at]]
        self.first, self.count, self.used = (np.cumsum(count) - count).astype(np.int32), count, len(at)
        self.parent, self.root, self.hits, self.skipped = new[self.parent[kept]], new[root[kept]], hits[kept] // 2, self.skipped[kept]
        kept = kept.tolist()
        self.ids, self.unit = [self.ids[i] for i in kept], [self.unit[i] for i in kept]
        self.plain = {u: i for i, (u, r) in enumerate(zip(self.unit, self.root.tolist(), strict=True)) if i == r}

    def choose(self, cut: np.ndarray, keys: np.ndarray, limit: int) -> np.ndarray:
        """The cut that each unit gets, from its plain one and its own key."""
        cut, done = cut.copy(), np.zeros(len(cut), np.int32)
        alive = np.flatnonzero(self.count[cut] > 0)
        while len(alive):
            parked, merges = [], []
            # The next skipped merge of each unit, merge by merge.
            while len(alive):
                at = self.first[cut[alive]] + done[alive]
                skip = _skips_array(keys[alive], self.borders[at], limit)
                parked.append(alive[skip])
                merges.append(at[skip])
                alive = alive[~skip]
                done[alive] += 1
                alive = alive[done[alive] < self.count[cut[alive]]]
            alive, at = np.concatenate(parked), np.concatenate(merges)
            new, where = np.unique(np.where(self.child[at] < 0, at, -1), return_index=True)
            new, where = (new[1:], where[1:]) if len(new) and new[0] < 0 else (new, where)
            if len(new):
                parent = cut[alive[where]]
                units = [self.unit[i] for i in parent.tolist()]
                order = np.argsort(np.fromiter(map(len, units), np.int64, len(units)), kind="stable")
                units, new, old = [units[i] for i in order], new[order], len(self.ids)
                self.add(units, self.symbols(units), parent[order], self.borders[new])
                self.child[new] = np.arange(old, old + len(new))
            cut[alive] = self.child[at]
            alive = alive[done[alive] < self.count[cut[alive]]]
        return cut


class Encoder:
    """Encodes texts; each unit's skips are drawn by the document's key and the unit's place in the text."""

    def __init__(self, table: PieceTable, dropout: float, seed: int, streams: int = 0):
        self.table, self.limit, self.seed, self.streams = table, round(dropout * (1 << 31)), seed, streams
        self.cuts = Cuts(table)

    def stream(self, doc_key: str) -> int:
        """The document's part of the key; with ``streams``, one of so many."""
        x = xxhash.xxh3_64_intdigest(doc_key.encode("utf-8", "surrogatepass"), (self.seed + 1) & _M64)
        return x % self.streams if self.streams else x

    def _symbols(self, unit: str) -> tuple[list[int], list[str]]:
        """Symbols of one unit; characters without a piece become stand-ins that never merge."""
        symbols = [int(self.table.of_code[ord(ch)]) or _ODD for ch in unit]
        return symbols, [ch for ch, i in zip(unit, symbols, strict=True) if i == _ODD]

    def _long(self, unit: str, key: int) -> bytes:
        symbols, odd = self._symbols(unit)
        return self.cuts.with_bytes(merge_with_agenda(symbols, self.table, key, self.limit), iter(odd))

    def encode(self, texts: list[str | None], doc_keys: list[str]) -> list[bytes | None]:
        """Ids of whole texts as bytes, 4 to an id. Units of all texts are merged together; very long
        texts come in slices, several rounds long."""
        out: list[list[bytes] | None] = [None if t is None else [] for t in texts]
        held, size = [], 0
        for i, (text, doc_key) in enumerate(zip(texts, doc_keys, strict=True)):
            if not text:
                continue
            key, place = _unit_key(text, self.seed, self.stream(doc_key)) if self.limit else 0, 0
            for units in _units(text, self.table.unit):
                held.append((i, key, place, units))
                place += len(units)
                size += len(units)
                if size >= SLICE_CHARS // 4:
                    self._flush(held, out)
                    held, size = [], 0
        self._flush(held, out)
        return [None if x is None else b"".join(x) for x in out]

    def _flush(self, held: list[tuple[int, int, int, list[str]]], out: list) -> None:
        if not held:
            return
        cuts = self.cuts
        if len(cuts.ids) > CACHE_UNITS:
            cuts.trim(CACHE_UNITS // 2)
        every = list(chain.from_iterable(units for *_, units in held))
        cut = np.fromiter(map(cuts.plain.get, every, repeat(-1)), np.int32, len(every))
        missing = np.flatnonzero(cut < 0)
        units = [every[i] for i in missing.tolist()]
        if new := {u for u in units if len(u) <= ARRAY_SYMBOLS}:
            cuts.learn(sorted(new))
            cut[missing] = np.fromiter(map(cuts.plain.get, units, repeat(-1)), np.int32, len(units))
        long_, keys = np.flatnonzero(cut < 0), None
        cuts.hits[: len(cuts.ids)] += np.bincount(cut[cut >= 0], minlength=len(cuts.ids)).astype(np.int32)
        if self.limit:
            keys = np.concatenate([place_keys(key, np.arange(place, place + len(units))) for _, key, place, units in held])
            short = np.flatnonzero(cut >= 0)
            cut[short] = cuts.choose(cut[short], keys[short], self.limit)
        at, known = 0, {}
        for i, _, _, units in held:
            end = at + len(units)
            ids = list(map(cuts.ids.__getitem__, cut[at:end].tolist()))
            for k in long_[np.searchsorted(long_, at) : np.searchsorted(long_, end)].tolist():
                key, unit = int(keys[k]) if self.limit else 0, units[k - at]
                if (unit, key) not in known:
                    known[unit, key] = self._long(unit, key)
                ids[k - at] = known[unit, key]
            out[i].append(b"".join(ids))
            at = end


def _units(text: str, unit: re.Pattern) -> Iterator[list[str]]:
    """Units (a run of spaces and what follows it, or a line end) of a text behind a leading space,
    in slices that end before a space; no merge crosses a unit."""
    text, at = " " + text if text else "", 0
    while at < len(text):
        end = at + SLICE_CHARS
        if end < len(text):
            while end < len(text) and not (text[end] == " " and text[end - 1] != " "):
                end += 1
        yield unit.findall(text, at, end) if end < len(text) else unit.findall(text, at)
        at = end


def _replace(batch: pa.RecordBatch, schema: pa.Schema, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else batch.column(f.name) for f in schema], schema=schema)


def _table(spark: SparkSession, model: str):
    """The piece table, read by Spark, so that ``model`` may lie in any store it reads, and broadcast (a vocabulary is fixed in size)."""
    path = model if "://" in model else f"file://{model}"
    proto = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    return shipped(spark, PieceTable(proto))


def encode_pieces(docs: DataFrame, dropout: float = 0.1, seed: int = 7, streams: int = 0, model: str = MODEL, copy: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text and other columns) with ``piece_ids``, array of int.

    Merges follow the model's scores; each candidate merge is skipped when a hash
    keyed by ``seed``, document (doc_id and text, and its number in the column
    ``copy`` if one is named), place of the unit in the text and borders falls
    below ``dropout``. So every occurrence of a word is cut on its own, and a
    rerun gives the same ids. With dropout 0 the ids are those of the model's own
    library. ``streams`` > 0 leaves only so many segmentations of one text.

    Defined cases: null text has null ids, empty text no ids; a null doc_id is the
    key "None"; texts of any length are worked off in slices; repeated rows give
    equal ids unless ``copy`` tells them apart; an existing column ``piece_ids`` is
    replaced; others are kept.
    """
    shared = _table(docs.sparkSession, model)
    schema = T.StructType([f for f in docs.schema if f.name != "piece_ids"]).add("piece_ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        encoder, arrow = Encoder(shared(), dropout, seed, streams), to_arrow_schema(schema)
        for whole in batches:
            for batch in _by_size(whole, "text"):
                keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
                names = list(map(str, keys)) if copy is None else [f"{k} {n}" for k, n in zip(keys, batch.column(copy).to_pylist(), strict=True)]
                ids = encoder.encode(texts, names)
                ends = np.cumsum([0, *(len(x or b"") // 4 for x in ids)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(x for x in ids if x), np.int32))
                nulls = pa.array([x is None for x in ids], pa.bool_())
                yield _replace(batch, arrow, {"piece_ids": pa.ListArray.from_arrays(pa.array(ends), flat, mask=nulls).cast(arrow.field("piece_ids").type)})

    return docs.mapInArrow(run, schema)


def _by_size(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of a few million characters or one row, to bound the memory of Python objects."""
    sizes = np.cumsum([len(x.as_buffer() or b"") if x.is_valid else 0 for x in batch.column(column)]) if batch.num_rows else np.empty(0)
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + 4 * SLICE_CHARS)))
        yield batch.slice(at, end - at)
        at = end


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``: the text that ``piece_ids`` stand for (null ids: null).

    Exact for every text: spaces, line ends, and characters without a piece, which are bytes.
    """
    shared = _table(encoded.sparkSession, model)
    schema = T.StructType([f for f in encoded.schema if f.name != "decoded"]).add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        of, arrow = shared().bytes_of, to_arrow_schema(schema)
        for batch in batches:
            column = batch.column("piece_ids")
            flat, at = column.values.to_numpy(), column.offsets.to_numpy()
            texts = [None if not ok else b"".join(map(of.__getitem__, flat[a:b].tolist()))[1:]
                     for ok, a, b in zip(column.is_valid().to_pylist(), at[:-1], at[1:], strict=True)]
            yield _replace(batch, arrow, {"decoded": pa.array(texts, pa.binary()).cast(arrow.field("decoded").type)})

    return encoded.mapInArrow(run, schema)
