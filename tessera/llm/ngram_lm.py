"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, kept as sorted hash arrays, mapped by workers."""

from __future__ import annotations

import os
from collections import OrderedDict, defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import (
    _SPACE, MIX, id_crc, load, merge_counts, mix64, pack_counts, pack_sorted, posix_folder, release, row_ranges, text_buffer,
    text_or_empty, unpack_counts, unpack_sorted, word_hashes, written,
)
from tessera.session import scratch

ORDER = 3  # words of the longest n-grams
CHUNK = 1 << 21  # bytes of text that are looked at together
HELD = 3_000_000  # n-grams that a task counts before it sends
PER_SHARD = 2_000_000  # tokens behind one owner of keys, about
PER_RANGE = 1 << 20  # n-grams whose lower-order figures one task adds up
KEY_BITS = 64  # of a key; where context and token need more, the token's lowest bits choose the owner too
INDEX_BITS = 16  # of a key, at most, that an index holds in place of the keys
MAPS = 256  # files that a worker keeps mapped
BLOCK = 1 << 14  # keys that are looked up together, so that they stay in the CPU's cache
PIECES = 16  # pieces of files that one task copies
END, START = mix64(np.array([0x454E44, 0x535441], dtype=np.uint64))  # stand for the end and the start of a text
_INVERSE = np.uint64(pow(int(MIX), -1, 1 << 64))
HELD_OUT, HELD_OUT_AT = 7, 2

_COUNTED = "owner int, keys binary, counts binary"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PARTS = "kind string, owner int, keys binary, counts binary, sums array<long>"
_CLASSES = ("one", "two", "more")


# ---- texts as tokens --------------------------------------------------------------------

@dataclass
class Piece:
    """Tokens of some whole texts, or of a slice of a long one.

    Each text is its ``lead`` (starts, or for a later slice the tokens before
    it), then its own tokens. ``bounds`` is where texts begin (one more
    entry), ``place`` each token's place in its text.
    """

    hashes: np.ndarray
    bounds: np.ndarray
    place: np.ndarray
    lead: int
    first: bool

    @property
    def own(self) -> np.ndarray:
        return self.place >= self.lead

    def counted(self, order: int) -> np.ndarray:
        """Where n-grams of an order end that count here; those of starts alone count once a text."""
        return self.place >= order - 1 if self.first else self.own

    def before(self, values: np.ndarray) -> np.ndarray:
        """The value at the token before, -1 at the first of a text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.place == 0] = -1
        return out


def _whole(data: np.ndarray, offsets: np.ndarray, lead: int) -> Piece:
    hashes, _, _, counts = word_hashes(data, offsets, lower=True)
    sizes = np.diff(counts) + lead + 1
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
    out = np.full(bounds[-1], START, dtype=np.uint64)
    word = place >= lead
    word[bounds[1:] - 1] = False
    out[word] = hashes
    out[bounds[1:] - 1] = END
    return Piece(out, bounds, place, lead, True)


def _next_space(data: np.ndarray, at: int, stop: int) -> int:
    while at < stop:
        found = np.flatnonzero(_SPACE[data[at:min(at + CHUNK, stop)]])
        if len(found):
            return at + int(found[0])
        at += CHUNK
    return stop


def pieces(data: np.ndarray, offsets: np.ndarray, lead: int, chunk: int | None = None
           ) -> Iterator[tuple[int, int, Piece, bool]]:
    """(first row, row after the last, piece, whether it ends its rows); a long text comes in slices, cut at spaces."""
    chunk = chunk or CHUNK
    for a, b in row_ranges(offsets, chunk):
        at, stop = int(offsets[a]), int(offsets[b])
        if stop - at <= 2 * chunk:
            yield a, b, _whole(data, offsets[a:b + 1], lead), True
            continue
        carry, first = np.full(lead, START, dtype=np.uint64), True
        while at < stop:
            cut = _next_space(data, min(at + chunk, stop), stop)
            hashes = word_hashes(data, np.array([at, cut]), lower=True)[0]
            row = np.concatenate([carry, hashes, np.full(int(cut == stop), END, dtype=np.uint64)])
            yield a, b, Piece(row, np.array([0, len(row)]), np.arange(len(row)), lead, first), cut == stop
            carry, first, at = row[-lead:], False, cut


# ---- the model --------------------------------------------------------------------------

def _save(folder: str, name: str, values: np.ndarray) -> None:
    """Write a file whole or not at all, so that a second attempt of a task does no harm."""
    os.makedirs(folder, exist_ok=True)
    part = os.path.join(folder, f".{name}.{os.getpid()}.part")
    with open(part, "wb") as f:
        np.save(f, values)
    os.replace(part, os.path.join(folder, f"{name}.npy"))


def _save_values(folder: str, name: str, order: int, piece: int, values: np.ndarray) -> int:
    """Numbers of few different values: the values, and for each number which one, in as few bytes as will do.

    Returns how many values there are.
    """
    table, codes = np.unique(values, return_inverse=True)
    _save(folder, f"{name}.values-{order}-{piece}", table)
    _save(folder, f"{name}-{order}-{piece}", codes.astype(np.min_scalar_type(max(len(table) - 1, 0))))
    return len(table)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more.

    ``n`` holds how many n-grams occur once to four times. Where that gives
    none (too little text), the discounts are 0.5, 1.0 and 1.5.
    """
    n1, n2, n3, n4 = n
    if min(n) > 0:
        y = n1 / (n1 + 2 * n2)
        d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < x < i for x, i in zip(d, (1, 2, 3))):
            return d
    return 0.5, 1.0, 1.5


def _off(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """The discount of each count."""
    return np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)]


@dataclass
class Grams:
    """Where the n-grams of one order are.

    The key of an n-gram is its context's id and its last token's id, mixed
    one to one within ``width`` bits, so no two meet; that of a single token
    is its hash. Owners are ranges of keys (the first ``bits`` bits) and, if
    context and token need more than ``KEY_BITS``, the token's lowest
    ``classes`` bits. An id is the place in all owners' keys.
    """

    bits: int = 1
    width: int = 64
    token_bits: int = 0
    classes: int = 0
    bases: list[int] = field(default_factory=lambda: [0, 0, 0])  # ids before each owner's, and all
    off: tuple[float, float, float] = (0.5, 1.0, 1.5)
    index_bits: int = INDEX_BITS

    @classmethod
    def after(cls, contexts: int, tokens: int, bits: int, key_bits: int, total: float = float("inf")) -> Grams:
        """For contexts and tokens of so many kinds, and about ``total`` n-grams in the texts."""
        own, other = max(tokens - 1, 1).bit_length(), max(contexts - 1, 1).bit_length()
        classes = min(max(0, own + other - key_bits), own)
        return cls(bits, max(own + other - classes, bits), own - classes, classes, [0] * ((1 << (bits + classes)) + 1),
                   index_bits=_index_bits(total / (1 << (bits + classes)) / 32))

    @property
    def size(self) -> int:
        return self.bases[-1]

    @property
    def rest(self) -> int:
        """Bits of a key within its owner."""
        return self.width - self.bits

    def _cut(self, keys: np.ndarray, bits: int) -> np.ndarray:
        return keys if bits >= 64 else keys & np.uint64((1 << bits) - 1)

    def keys(self, context: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and key."""
        plain = (context.astype(np.uint64) << np.uint64(self.token_bits)) | (token >> self.classes).astype(np.uint64)
        return token & ((1 << self.classes) - 1), self._cut(plain * MIX, self.width)

    @property
    def low(self) -> int:
        """Bits of a key that are kept one by one; an index by the bits between holds where those begin."""
        low = max(self.rest - self.index_bits, min(self.rest, 8))
        return 32 if low > 32 >= self.rest - INDEX_BITS else low

    @property
    def kind_of_key(self) -> np.dtype:
        return np.min_scalar_type((1 << self.low) - 1)

    @property
    def indexed(self) -> int:
        """Entries of an owner's index."""
        return 1 << (self.rest - self.low)

    def local(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys without their owner's bits: index, and rest."""
        own = self._cut(keys, self.rest)
        high = np.zeros(len(own), np.int64) if self.low == self.rest else (own >> np.uint64(self.low)).astype(np.int64)
        return high, self._cut(own, self.low).astype(self.kind_of_key)

    def whole(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of a class: index, among those of all owners, and rest."""
        high = (keys >> np.uint64(self.low)) | np.uint64(kind << (self.width - self.low))
        return high.astype(np.int64), self._cut(keys, self.low).astype(self.kind_of_key)

    def index(self, high: np.ndarray) -> np.ndarray:
        """Where each index's keys begin, and their end."""
        return np.searchsorted(high, np.arange(self.indexed + 1))

    def parts(self, owner: int | np.ndarray, high: np.ndarray, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and last token of kept keys."""
        owner = np.uint64(owner)
        top = (owner & np.uint64((1 << self.bits) - 1)) << np.uint64(self.rest)
        between = high.astype(np.uint64) << np.uint64(self.low) if self.low < self.rest else np.uint64(0)
        plain = self._cut((top | between | local.astype(np.uint64)) * _INVERSE, self.width)
        token = (self._cut(plain, self.token_bits) << np.uint64(self.classes)) | (owner >> np.uint64(self.bits))
        return (plain >> np.uint64(self.token_bits)).astype(np.int64), token.astype(np.int64)

    def ranges(self, keys: np.ndarray) -> np.ndarray:
        """Where each owner's part of sorted keys of a class begins, and their end."""
        firsts = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(self.rest)
        return np.append(np.searchsorted(keys, firsts), len(keys))

    @property
    def firsts(self) -> np.ndarray:
        """First ids of the ranges of ids that what the order above tells is dealt to, and all."""
        step = min(PER_RANGE, max(1, -(-self.size // 16)))
        return np.append(np.arange(0, self.size, step), self.size)


def _index_bits(n: float) -> int:
    """Bits for about ``n`` entries, as far as allowed."""
    return int(min(INDEX_BITS, max(0, np.log2(max(n, 1)))))


def _place(held: np.ndarray, wanted: np.ndarray, high: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place in the kept keys for each wanted one, and whether it stands there, among those of its index."""
    place, found = np.empty(len(wanted), np.int64), np.empty(len(wanted), bool)
    for a in range(0, len(wanted), BLOCK):
        keys, of = wanted[a:a + BLOCK], high[a:a + BLOCK]
        at = index[of].astype(np.int64)
        left = index[of + 1].astype(np.int64) - at
        some = left > 0
        for _ in range(max(int(left.max()) - 1, 0).bit_length()):
            half = left >> 1
            at += half * (held[at + half - 1] < keys)
            left -= half
        place[a:a + BLOCK] = np.minimum(at, len(held) - 1, out=at)
        found[a:a + BLOCK] = some & (held[at] == keys)
    return place, found


def _distinct(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of ``width`` bits in about their order, without most of the repeated ones, and which is each key's.

    Places and the leading bits of keys are sorted as one number, which is
    much faster than ``np.unique`` with its inverse.
    """
    bits = max(len(keys) - 1, 1).bit_length()
    codes = keys >> np.uint64(max(0, width + bits - 64))
    codes <<= np.uint64(bits)
    codes |= np.arange(len(keys), dtype=np.uint64)
    codes.sort()
    codes &= np.uint64((1 << bits) - 1)
    order = codes.view(np.int64)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(new) - 1
    return ordered[new], back


@dataclass
class KneserNey:
    """A model in a shared folder; workers map its files as they need them, ``MAPS`` at a time.

    For order k, ``keys-k`` are the low bits of the sorted keys of owner after
    owner, ``index-k`` says where those of each leading bits begin, and aligned
    with the keys are, as places in their ``.values``: ``counts`` (how often),
    and below the highest order ``follow`` (how many different tokens come
    before it), ``left`` (the share that it leaves, as a context, to the lower
    order) and ``all`` (the sum that it divides as a context; under the highest
    order that is ``counts``). Owners and ranges of ids wrote pieces of these
    files, each with values of its own; there are as many files for any number
    of pieces, and a lookup goes through all owners at once.
    """

    folder: str
    order: int = ORDER
    grams: list[Grams] = field(default_factory=list)
    total: int = 0  # training tokens
    start: int = -1  # the id that stands before texts
    pairs: int = 0  # different pairs of neighbours
    unknown: float = 1.0  # share of the lowest order that goes to all tokens alike
    files: dict[str, tuple[str, int]] = field(default_factory=dict)  # type and length
    tables: dict[str, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # pieces: first ids, first values

    def __post_init__(self):
        self._maps: OrderedDict[str, np.ndarray | None] = OrderedDict()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_maps"} | {"_maps": OrderedDict()}

    @property
    def lead(self) -> int:
        return self.order - 1

    @property
    def vocabulary(self) -> int:
        return self.grams[0].size - 1 if self.grams else 0

    def mapped(self, name: str, order: int) -> np.ndarray:
        file = f"{name}-{order}"
        if file not in self._maps:
            kind, n = self.files[file]
            path = os.path.join(self.folder, file)
            self._maps[file] = np.asarray(np.memmap(path, kind, "r", shape=(n,))) if n else np.empty(0, kind)
            if len(self._maps) > MAPS:
                self._maps.popitem(last=False)
        self._maps.move_to_end(file)
        return self._maps[file]

    def values(self, name: str, order: int, ids: np.ndarray) -> np.ndarray:
        """What a file holds for these n-grams."""
        firsts, at = self.tables[f"{name}-{order}"]
        places = at[np.searchsorted(firsts, ids, side="right") - 1] + self.mapped(name, order)[ids]
        return self.mapped(f"{name}.values", order)[places]

    def _search(self, order: int, keys: np.ndarray, names: tuple[str, ...], kind: int = 0) -> list[np.ndarray]:
        """Id (-1: unknown) of each of some keys of a class, and what the files ``names`` hold for it."""
        out = [np.full(len(keys), -1, np.int64), *[np.zeros(len(keys)) for _ in names]]
        held = self.mapped("keys", order)
        if len(held):
            high, wanted = self.grams[order - 1].whole(kind, keys)
            at, hit = _place(held, wanted, high, self.mapped("index", order))
            ids = at[hit]
            out[0][hit] = ids
            for i, name in enumerate(names, 1):
                out[i][hit] = self.values(name, order, ids)
        return out

    def kept(self, order: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and last token of the n-grams of these ids."""
        g, index = self.grams[order - 1], self.mapped("index", order)
        high = np.searchsorted(index, ids.astype(index.dtype), side="right") - 1
        return g.parts(high // g.indexed, high % g.indexed, self.mapped("keys", order)[ids])

    def words(self, hashes: np.ndarray, names: tuple[str, ...] = ()) -> list[np.ndarray]:
        """Ids of tokens, and what ``names`` hold."""
        if not self.grams:
            return [np.full(len(hashes), -1, np.int64), *[np.zeros(len(hashes)) for _ in names]]
        keys, back = _distinct(hashes, 64)
        return [v[back] for v in self._search(1, keys, names)]

    def find(self, order: int, context: np.ndarray, token: np.ndarray, names: tuple[str, ...] = ()) -> list[np.ndarray]:
        """Ids of n-grams, and what ``names`` hold; -1 and 0 where a part is unknown."""
        out = [np.full(len(token), -1, np.int64), *[np.zeros(len(token)) for _ in names]]
        known = np.flatnonzero((context >= 0) & (token >= 0))
        if not len(known):
            return out
        kinds, keys = self.grams[order - 1].keys(context[known], token[known])
        for kind in np.unique(kinds):
            mine = np.flatnonzero(kinds == kind)
            distinct, back = _distinct(keys[mine], self.grams[order - 1].width)
            for held, got in zip(out, self._search(order, distinct, names, int(kind))):
                held[known[mine]] = got[back]
        return out

    def rest_of(self, order: int, ids: np.ndarray) -> np.ndarray:
        """The id, one order lower, of n-grams without their first token."""
        distinct, back = _distinct(ids.astype(np.uint64), self.grams[order - 1].size.bit_length())
        distinct = distinct.astype(np.int64)
        return (self.kept(2, distinct)[1] if order == 2 else self.mapped("rest", order)[distinct])[back]

    def suffix(self, order: int, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        """As :meth:`rest_of`, for n-grams given as context and last token."""
        return token if order == 2 else self.find(order - 1, self.rest_of(order - 1, context), token)[0]

    def score(self, piece: Piece) -> dict[str, np.ndarray]:
        """n_tokens, n_known, base_score and score of each text of a piece."""
        def names(order: int) -> tuple[str, ...]:
            if order == self.order:
                return ("counts",)
            return ("follow", "left", "counts" if order == self.order - 1 else "all")

        ids, counts, *held = self.words(piece.hashes, ("counts", *names(1)))
        token = ids
        logs_of = (np.maximum(held[0] - _off(held[0], self.grams[0].off), 0.0) if self.grams else 0.0)
        p = logs_of / max(self.pairs, 1) + self.unknown / (self.vocabulary + 1)
        for k in range(2, self.order + 1 if self.grams else 0):
            context, left, whole = piece.before(ids), piece.before(held[1]), piece.before(held[2])
            ids, *held = self.find(k, context, token, names(k))
            high = np.maximum(held[0] - _off(held[0], self.grams[k - 1].off), 0.0) / np.maximum(whole, 1.0)
            p = np.where((context >= 0) & (whole > 0), high + left * p, p)
        own, first = piece.own, piece.bounds[:-1]
        base = np.log10((counts + 1.0) / (self.total + self.vocabulary + 1.0))
        sums = {"n_tokens": own, "n_known": own & (counts > 0), "base_score": np.where(own, base, 0.0),
                "score": np.where(own, np.log10(np.where(own, p, 1.0)), 0.0)}
        return {n: np.add.reduceat(v.astype(np.int64) if v.dtype == bool else v, first) for n, v in sums.items()}


# ---- counting ---------------------------------------------------------------------------

def _deal(g: Grams, kind: int, held: list[np.ndarray]) -> pa.RecordBatch:
    """Sorted keys of a class and their counts, cut by owners."""
    keys, counts = np.unique(np.concatenate(held), return_counts=True)
    cuts = g.ranges(keys)
    shards = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_arrays(
        [pa.array((kind << g.bits | shards).astype(np.int32)),
         pa.array([pack_sorted(keys[cuts[s]:cuts[s + 1]]) for s in shards], pa.binary()),
         pa.array([pack_counts(counts[cuts[s]:cuts[s + 1]]) for s in shards], pa.binary())],
        names=["owner", "keys", "counts"])


def _counted(texts: DataFrame, model: KneserNey, order: int, chunk: int) -> DataFrame:
    """Counts of the n-grams of an order over all texts, summed within tasks and dealt to owners."""
    g = model.grams[order - 1]

    def found(piece: Piece) -> Iterator[tuple[int, np.ndarray]]:
        mine = piece.counted(order)
        if order == 1:
            yield 0, piece.hashes[mine]
            return
        token = ids = model.words(piece.hashes)[0]
        for k in range(2, order):
            ids = model.find(k, piece.before(ids), token)[0]
        kinds, keys = g.keys(piece.before(ids)[mine], token[mine])
        for kind in np.unique(kinds):
            yield int(kind), keys[kinds == kind] if g.classes else keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = defaultdict(list), 0
        for batch in batches:
            for _, _, piece, _ in pieces(*text_buffer(batch["text"]), model.lead, chunk):
                for kind, keys in found(piece):
                    held[kind].append(keys)
                    n += len(keys)
                if n >= HELD:
                    yield from (_deal(g, kind, keys) for kind, keys in held.items())
                    held, n = defaultdict(list), 0
        yield from (_deal(g, kind, keys) for kind, keys in held.items())

    return texts.mapInArrow(run, _COUNTED)


def _merged(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return merge_counts([unpack_sorted(k) for k in pdf["keys"]], [unpack_counts(c) for c in pdf["counts"]])


def _by_range(kind: str, ids: np.ndarray, counts: np.ndarray, g: Grams) -> list[tuple]:
    """Counts by sorted id, cut by ranges of ids."""
    cuts = np.searchsorted(ids, g.firsts)
    return [(kind, int(o), pack_sorted(ids[a:b].astype(np.uint64)), pack_counts(counts[a:b]), None)
            for o in np.flatnonzero(np.diff(cuts)) for a, b in [(cuts[o], cuts[o + 1])]]


def _below(model: KneserNey, order: int, context: np.ndarray, token: np.ndarray, values: np.ndarray) -> list[tuple]:
    """What n-grams of an order tell those one order lower: their classes as contexts, and who follows whom."""
    ends = token != model.start
    context, token, values = context[ends], token[ends], values[ends]
    g = model.grams[order - 2]
    out = [("sum", -1, b"", b"", [*[int((values == i).sum()) for i in (1, 2, 3, 4)], len(values)])]
    for i, kind in enumerate(_CLASSES, 1):
        out += _by_range(kind, *np.unique(context[np.minimum(values, 3) == i], return_counts=True), g)
    if order < model.order:
        ids, back = np.unique(context, return_inverse=True)
        out += _by_range("all", ids, np.bincount(back, values, len(ids)).astype(np.int64), g)
    return out + _by_range("follow", *np.unique(model.suffix(order, context, token), return_counts=True), g)


def _joined(spark: SparkSession, model: KneserNey, order: int, firsts: np.ndarray, plain: dict[str, np.dtype],
            coded: dict[str, np.ndarray]) -> None:
    """Put the pieces of an order's files into one file each and delete them.

    ``firsts`` are the pieces' first ids, and all; ``coded`` has how many
    values each piece has, 0 for one that nobody wrote: it holds zeros.
    """
    n, indexed, jobs = len(firsts) - 1, model.grams[order - 1].indexed, []
    for name, kind in plain.items():
        jobs.append((name, kind, np.arange(n + 1) * indexed if name == "index" else firsts))
    for name, sizes in coded.items():
        at = np.concatenate(([0], np.cumsum(np.maximum(sizes, 1))))
        jobs.append((name, np.min_scalar_type(int(max(sizes.max() - 1, 0))), firsts))
        jobs.append((f"{name}.values", np.dtype(float if name == "left" else np.int64), at))
        model.tables[f"{name}-{order}"] = firsts[:-1], at[:-1]
    for name, kind, at in jobs:
        size = int(at[-1]) + (name == "index")
        model.files[f"{name}-{order}"] = kind.str, size
        with open(os.path.join(model.folder, f"{name}-{order}"), "wb") as f:
            f.truncate(size * kind.itemsize)  # zeros, until they are written
            if name == "index":
                f.seek(int(at[-1]) * kind.itemsize)
                f.write(firsts[-1:].astype(kind).tobytes())
    folder = model.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch["id"].to_pylist():
                pieces = [os.path.join(folder, f"{name}-{order}-{i}.npy") for name, _, _ in jobs]
                for (name, kind, at), piece in zip(jobs, pieces):
                    if os.path.exists(piece):
                        values = np.load(piece)
                        if name == "index":
                            values = values[:-1] + firsts[i]
                    elif name == "index" and firsts[i] == firsts[i + 1]:
                        values = np.full(indexed, firsts[i])
                    else:  # nothing, or put there by an earlier attempt
                        continue
                    with open(os.path.join(folder, f"{name}-{order}"), "r+b") as f:
                        f.seek(int(at[i]) * kind.itemsize)
                        f.write(np.ascontiguousarray(values, kind))
                for piece in filter(os.path.exists, pieces):
                    os.remove(piece)
        yield from ()

    (spark.range(0, n, 1, -(-n // PIECES)).mapInArrow(run, "id long")
     .write.format("noop").mode("overwrite").save())


def _build(texts: DataFrame, model: KneserNey, order: int, chunk: int) -> DataFrame | None:
    """Write the sorted keys and counts of an order; of the highest, what it tells the order below."""
    g, top = model.grams[order - 1], order == model.order

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _merged(pdf)
        o = int(pdf["owner"].iat[0])
        high, local = g.local(keys)
        _save(model.folder, f"keys-{order}-{o}", local)
        _save(model.folder, f"index-{order}-{o}", g.index(high).astype(np.uint32 if len(keys) < 1 << 32 else np.uint64))
        sizes = [o, len(keys), int(counts.sum()), _save_values(model.folder, "counts", order, o, counts)]
        out = [("size", -2, b"", b"", sizes)]
        if top:
            out += _below(model, order, *g.parts(o, high, local), counts)
        elif order > 2:  # the order above follows these
            _save(model.folder, f"rest-{order}-{o}", model.suffix(order, *g.parts(o, high, local)))
        return pd.DataFrame(out, columns=["kind", "owner", "keys", "counts", "sums"])

    groups = _counted(texts, model, order, chunk).groupBy("owner")
    parts = written(texts.sparkSession, groups.applyInPandas(own, _PARTS))
    lengths, totals, different = _sizes(parts, 1 << (g.bits + g.classes), 3)
    g.bases = [0, *np.cumsum(lengths).tolist()]
    plain = {"keys": g.kind_of_key, "index": np.dtype(np.uint32 if g.size < 1 << 32 else np.uint64)}
    if 2 < order < model.order:
        plain["rest"] = np.dtype(np.int64)
    _joined(texts.sparkSession, model, order, np.array(g.bases), plain, {"counts": different})
    if order == 1:
        model.total = int(totals.sum())
    if top:
        return parts
    release(parts)
    return None


def _lower(spark: SparkSession, parts: DataFrame, model: KneserNey, order: int) -> DataFrame:
    """From what the order above tells, write an order's files; what it tells the next below."""
    g, d = model.grams[order - 1], model.grams[order].off
    firsts, names = g.firsts, ["left", "follow"] + ["all"] * (order < model.order - 1)

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        r = int(pdf["owner"].iat[0])
        base, n, got = int(firsts[r]), int(firsts[r + 1] - firsts[r]), {}
        for kind in (*_CLASSES, "all", "follow"):
            ids, counts = _merged(pdf[pdf["kind"] == kind])
            got[kind] = np.zeros(n, np.int64)
            got[kind][ids.astype(np.int64) - base] = counts
        if order == model.order - 1:
            got["all"] = model.values("counts", order, np.arange(base, base + n))
        got["left"] = sum(x * got[c] for x, c in zip(d, _CLASSES)) / np.maximum(got["all"], 1)
        out = [("size", -2, b"", b"", [r, *[_save_values(model.folder, name, order, r, got[name]) for name in names]])]
        seen = np.flatnonzero(got["follow"])
        values = got["follow"][seen]
        if order > 1:
            out += _below(model, order, *model.kept(order, base + seen), values)
        else:
            out.append(("sum", -1, b"", b"", [*[int((values == i).sum()) for i in (1, 2, 3, 4)], len(values)]))
        return pd.DataFrame(out, columns=["kind", "owner", "keys", "counts", "sums"])

    out = written(spark, parts.where("owner >= 0").groupBy("owner").applyInPandas(own, _PARTS))
    _joined(spark, model, order, firsts, {}, dict(zip(names, _sizes(out, len(firsts) - 1, len(names)))))
    return out


def _sizes(parts: DataFrame, n: int, kinds: int) -> np.ndarray:
    """What ``n`` pieces of files say of their sizes, 0 where nobody wrote a piece."""
    out = np.zeros((kinds, n), dtype=np.int64)
    for (sums,) in parts.where("owner = -2").select("sums").collect():
        out[:, sums[0]] = sums[1:]
    return out


def _sums(parts: DataFrame) -> list[int]:
    """How many values are one to four, and how many there are."""
    return list(parts.where("owner = -1").select(
        *[F.coalesce(F.sum(F.element_at("sums", i)), F.lit(0)).alias(f"s{i}") for i in range(1, 6)]).first())


def _bits(n: float) -> int:
    """Enough bits for about ``n`` shards, one at least."""
    return max(1, int(np.ceil(np.log2(max(n, 2)))))


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Lets Spark delete a job's shuffle files when it ends: what it gave is written by then."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER, *, per_shard: int = PER_SHARD,
          key_bits: int = KEY_BITS, chunk: int = CHUNK) -> KneserNey:
    """Count all texts of ``docs`` and write the model of n-grams of up to ``order`` (2 at least) to the shared folder.

    Order by order, tasks count their own n-grams before anything is
    shuffled; the owner of a key range adds the counts up and writes one
    file. Ranges are of mixed keys, so a frequent word or context is spread
    over all owners; the number of owners follows the size of the texts.
    From the highest order down, owners then tell the next lower one how
    many followers of which count each context has, and how many different
    tokens come before each n-gram. What the driver gets is a row of sums
    per owner. Each text is preceded by ``order - 1`` starts.

    A text longer than ``2 * chunk`` bytes is taken in slices cut at spaces
    (a single word is taken whole). The folder must be one that all workers
    mount. No number of different tokens or n-grams is too large.
    """
    if order < 2:
        raise ValueError("order must be 2 at least")
    spark = docs.sparkSession
    texts = docs.select(text_or_empty(text_col).alias("text"))
    size, n_texts = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    model = KneserNey(posix_folder(scratch(spark)), order)
    if not n_texts:
        return model
    bits = _bits(max(16, (size / 6 + n_texts) / per_shard))
    with _shuffles_deleted(spark):
        for k in range(1, order + 1):
            if k == 1:
                model.grams.append(Grams(bits, bases=[0] * ((1 << bits) + 1),
                                         index_bits=_index_bits(per_shard / 512)))
            else:
                model.grams.append(Grams.after(model.grams[-1].size, model.grams[0].size, bits, key_bits,
                                               model.total + n_texts * model.lead))
            parts = _build(texts, model, k, chunk)
            if k == 1:
                model.total -= n_texts * model.lead  # starts are no tokens
                model.start = int(model.words(np.array([START]))[0][0])
        for k in range(order, 0, -1):
            *of_counts, different = _sums(parts)
            model.grams[k - 1].off = discounts(of_counts)
            if k == 2:
                model.pairs = different
            above = parts
            if k > 1:
                parts = _lower(spark, above, model, k - 1)
            release(above)
    d, (n1, n2, _, _) = model.grams[0].off, of_counts
    model.unknown = (d[0] * n1 + d[1] * n2 + d[2] * (different - n1 - n2)) / model.pairs
    return model


def score_documents(docs: DataFrame, model: KneserNey, *, id_col: str = "doc_id", text_col: str = "text",
                    chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each row's whole text.

    ``score`` is the model's log10 probability of the text and its end,
    ``base_score`` that of single tokens with one added to every count. A
    null text is empty: one token, its end. Rows pass unshuffled, repeated
    ones and null ids too; other columns are ignored. A very long text is
    scored in slices. Without any training text every token scores 0.
    """
    names = ["n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = None
            for a, b, piece, last in pieces(*text_buffer(batch["text"]), model.lead, chunk):
                got = model.score(piece)
                held = {n: held[n] + got[n] for n in names} if held else got
                if last:
                    yield pa.RecordBatch.from_arrays(
                        [batch["doc_id"].slice(a, b - a), *[pa.array(held[n]) for n in names]],
                        names=["doc_id", *names])
                    held = None

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return (rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
            .select("doc_id", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
                    "base_score", "score"))


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: its id's CRC-32 leaves 2 when divided by 7."""
    return F.pmod(id_crc(id_col), F.lit(HELD_OUT)) == HELD_OUT_AT


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of those that are not held out."""
    docs = load(spark, sf_dir, "documents")
    scored = score_documents(docs, train(docs.where(~held_out())))
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")
