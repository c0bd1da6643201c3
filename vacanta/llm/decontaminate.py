"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question asked again
with other values has the template windows of the original. Windows of
``WINDOW`` tokens of all documents and all items meet in a hash join; what
each placeholder stood for comes along. A document holds an item if, in one
stretch or alignment of it, enough of the item's windows occur with consistent slots: a
value of the item must become the same value wherever it occurs. So does a
document with a run of ``RUN`` or more tokens of an item, however long that is.

What is a name depends on letter case. So windows of the plain words, without
placeholders and without case, are joined beside the template windows; of the
two coverages the better one counts.

Items too short for a window, and items in scripts without spaces, where words
have no edges, are also looked for whole: one hash of all their words or, in
such scripts, characters, joined with the sequences of that length.

Before the join a Bloom filter of fixed size over the benchmark's windows leaves
out nearly all windows of clean documents. A benchmark too large for the filter
makes it useless, never wrong. Documents and items are candidates for each other
where they share one of the item's anchors: windows chosen by how often documents
have them, so that no leak is without one. Joins are left to Spark's own size
checks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.llm.common import bloom_bits, in_bloom, mix_bits, park, powers

WINDOW = 5
LITERAL = 3  # tokens of a window that must be no placeholders
COVERAGE = 0.5  # of an item's windows
RUN = 13  # consecutive tokens of an item that are a leak, whatever share of it
PIECE = 1 << 20  # characters of a text that are read at once
CHARS_AT_ONCE = 1 << 16  # of short texts

# Fixed values.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million"
).split()
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds "
    "ounce ounces ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days "
    "week weeks month months year years dollar dollars cent cents euro euros percent degree degrees meter meters "
    "metre metres kilometer kilometers centimeter centimeters mph kmh watt watts volt volts usd eur"
).split()
NAMES = (
    "alice bob carol david emma frank grace henry james john mary michael sarah tom anna peter paul laura maria "
    "susan robert linda jack lucy sam ben kate mark julia daniel"
).split()

TEMPLATE, PLAIN, WHOLE, ANCHOR = 0, 1, 2, 3  # kinds of windows; an anchor opens a whole item

# Thai, Lao, Tibetan, Burmese, Khmer, kana and Chinese characters in the basic plane.
SPACELESS = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
)

_END, _LITERAL, _CAPITAL, _SLOT = 0, 1, 2, 3  # the two low bits of a token's code
NUMBER_SLOT, UNIT_SLOT, NAME_SLOT = (xxhash.xxh64_intdigest(f"<{s}>") & ~3 | _SLOT for s in ("number", "unit", "name"))


class Letters(NamedTuple):
    """What each character of the basic plane is: other, letter, digit or end of a sentence."""

    kind: np.ndarray
    folded: np.ndarray
    upper: np.ndarray
    alone: np.ndarray  # letters of scripts without spaces

    @classmethod
    def table(cls) -> Letters:
        chars = [chr(i) for i in range(1 << 16)]
        kind = np.array([c.isalpha() + 2 * c.isdecimal() for c in chars], np.uint8)
        kind[[ord(c) for c in ".!?:\n。！？："]] = 3
        folded = np.array([ord(c.casefold()) if len(c.casefold()) == 1 else ord(c) for c in chars], np.uint64)
        alone = np.zeros(len(chars), bool)
        for low, high in SPACELESS:
            alone[low : high + 1] = kind[low : high + 1] == 1
        return cls(kind, folded, np.array([c.isupper() for c in chars]), alone)


def unsharp(text: str) -> str:
    """The text with ss for the sharp s, the one common letter whose upper case is two."""
    return text.replace("ß", "ss").replace("ẞ", "ss")


def running(hashes: np.ndarray) -> np.ndarray:
    """Sums from which ``sequences`` takes the hashes of stretches of tokens."""
    up, _ = powers(len(hashes) + 1)
    return np.concatenate([[np.uint64(0)], np.cumsum(hashes * up[: len(hashes)])])


def sequences(sums: np.ndarray, length: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Hash of each ``length`` consecutive tokens, or of those at ``starts``."""
    _, down = powers(len(sums))
    n = max(0, len(sums) - length)
    if starts is None:
        return mix_bits((sums[length : length + n] - sums[:n]) * down[:n] + np.uint64(length))
    return mix_bits((sums[starts + length] - sums[starts]) * down[starts] + np.uint64(length))


class Words(NamedTuple):
    """Tokens without ends of sentences; whether each opens and closes a sentence."""

    hashes: np.ndarray
    first: np.ndarray
    opens: np.ndarray
    closes: np.ndarray

    @classmethod
    def of(cls, found: tuple | None) -> Words:
        if found is None or not len(found[0]):
            return cls(np.zeros(0, np.uint64), *([np.zeros(0, np.int64)] * 3))
        stop = found[1] == 3
        opens, closes = np.concatenate([[True], stop[:-1]]), np.concatenate([stop[1:], [True]])
        return cls(found[0][~stop], found[2][~stop], opens[~stop], closes[~stop])


class Tokens(NamedTuple):
    """Tokens of some texts in one string, without ends of sentences.

    ``begins`` has the first character of each text, ``tokens`` the first token
    of each and the number of all; ``template`` and ``plain`` the windows' hashes.
    """

    text: str
    begins: np.ndarray
    tokens: np.ndarray
    row: np.ndarray  # text of each token
    end: np.ndarray
    slot: np.ndarray
    template: np.ndarray
    plain: np.ndarray
    words: Words


class Reader:
    """Tokens and windows of texts."""

    def __init__(self):
        self.letters = Letters.table()
        words = [(NUMBER_WORDS, NUMBER_SLOT), (UNITS, UNIT_SLOT), (NAMES, NAME_SLOT)]
        known = {}
        for some, slot in words:
            hashes = self._piece(" ".join(some))[0]
            known |= dict.fromkeys(hashes.tolist(), slot)
        self.known = np.array(sorted(known), np.uint64)
        self.slots = np.array([known[h] for h in sorted(known)], np.uint64)

    def _piece(self, text: str, fine: bool = False) -> tuple[np.ndarray, ...]:
        """(hash, kind, first, end, capital letters, opens with one) of the tokens of some characters.

        Runs of letters, runs of digits with points and commas between digits,
        and single ends of sentences are tokens; with ``fine`` also each
        letter of a script without spaces.
        """
        char = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), (1 << 16) - 1)
        kind = self.letters.kind[char]
        digit = kind == 2
        point = (char == 46) | (char == 44)
        point[1:-1] &= digit[:-2] & digit[2:]
        point[[0, -1]] = False
        kind = np.where(point, np.uint8(2), kind)
        change = np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == 3), [True]])
        if fine:
            alone = self.letters.alone[char]
            change[1:-1] |= alone[1:] | alone[:-1]
        edges = np.flatnonzero(change)
        first, end = edges[:-1], edges[1:]
        some = kind[first] != 0
        first, end = first[some], end[some]
        up, down = powers(len(char) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((self.letters.folded[char] + np.uint64(1)) * up[: len(char)])])
        upper = self.letters.upper[char]
        capitals = np.concatenate([[0], np.cumsum(upper, dtype=np.int32)])
        hashes = mix_bits((sums[end] - sums[first]) * down[first])
        return hashes, kind[first], first, end, capitals[end] - capitals[first], upper[first]

    def tokens(self, text: str, fine: bool = False):
        """As ``_piece`` for a whole text, read ``PIECE`` characters and up to a space at a time.

        A run of ``PIECE`` characters and more without any space may be cut.
        """
        if len(text) <= PIECE:
            return self._piece(text, fine) if text else None
        found, at = [], 0
        while at < len(text):
            end = text.find(" ", at + PIECE, at + 2 * PIECE)
            end = min(len(text), at + 2 * PIECE) if end < 0 else end
            part = self._piece(text[at:end], fine)
            found.append((*part[:2], part[2] + at, part[3] + at, *part[4:]))
            at = end
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def spaceless(self, text: str) -> np.ndarray:
        """Places of the letters of scripts without spaces."""
        if text.isascii():
            return np.zeros(0, np.int64)
        char = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        return np.flatnonzero(self.letters.alone[np.minimum(char, (1 << 16) - 1)])

    def own_key(self, text: str) -> list[tuple[int, int, int]]:
        """(kind, hash, length) by which an item is looked for whole, if it is."""
        spaceless = len(self.spaceless(text)) > 0
        words = Words.of(self.tokens(text, spaceless))
        length = len(words.hashes)
        if not length or (length >= WINDOW and not spaceless):
            return []
        sums = running(words.hashes)
        keys = [(WHOLE, int(sequences(sums, length)[0]), length)]
        if length >= WINDOW:
            keys.append((ANCHOR, int(sequences(sums, WINDOW)[0]), WINDOW))
        return keys

    def read(self, texts: list[str]) -> Tokens | None:
        """Tokens and windows of some texts, read as one.

        A line feed, an end of a sentence, stands between them, so each has the
        tokens that it has alone. In templates a capitalised word is a name unless it
        opens a sentence, and windows with fewer than ``LITERAL`` literal tokens say
        too little: their hash is 0, as is that of windows across two texts.
        """
        text = "\n".join(texts)
        found = self.tokens(text)
        if found is None or not len(found[0]):
            return None
        hashes, kind, first, end, capitals, opening = found
        word, stop = kind == 1, kind == 3
        code = hashes & ~np.uint64(3) | np.uint64(_LITERAL)
        spot = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        special = word & (self.known[spot] == hashes) & ((self.slots[spot] != NAME_SLOT) | (capitals > 0))
        code = np.where(special, self.slots[spot], code)
        code = np.where(kind == 2, np.uint64(NUMBER_SLOT), code)
        # One capital, the first letter: a name where it does not open a
        # sentence. In a run of such words, as in a headline, they are words.
        capital = word & ~special & (capitals == 1) & (end - first > 1) & opening
        opens, closes = np.concatenate([[True], stop[:-1]]), np.concatenate([stop[1:], [True]])
        near = np.concatenate([[False], capital[:-1]]) | np.concatenate([capital[1:], [False]])
        code = np.where(capital & ~opens & ~near, np.uint64(NAME_SLOT), code)
        kept = ~stop
        code, first, end = code[kept], first[kept], end[kept]
        words = Words(hashes[kept], first, opens[kept], closes[kept])
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        row = np.searchsorted(begins, first, "right") - 1
        slot = (code & np.uint64(3)) == _SLOT
        template, plain = (sequences(running(x), WINDOW) for x in (code, words.hashes))
        n = len(plain)
        across = row[:n] != row[WINDOW - 1 :][:n]
        slots = np.concatenate([[0], np.cumsum(slot, dtype=np.int32)])
        template[across | (slots[WINDOW:] - slots[:-WINDOW] > WINDOW - LITERAL if n else across)] = 0
        plain[across] = 0
        return Tokens(text, begins, np.searchsorted(row, np.arange(len(texts) + 1)), row, end, slot, template, plain, words)

    def whole(self, read: Tokens, lengths: list[int], bits: bytes) -> Iterator[tuple[int, int, int, np.uint64]]:
        """(text, first, last token in it, hash) of the sequences of some lengths that the Bloom filter knows.

        One or two words alone are no question: such items must be a sentence
        of their own.
        """
        rows = np.unique(np.searchsorted(read.begins, self.spaceless(read.text), "right") - 1)
        spaced = ~np.isin(read.row, rows)
        for first, last, found in self._known(read.words, lengths, bits, None, read.row, spaced):
            i = read.row[first]
            yield int(i), int(first - read.tokens[i]), int(last - read.tokens[i]), found
        for i in rows.tolist():
            low = int(read.begins[i])
            high = int(read.begins[i + 1]) - 1 if i + 1 < len(read.begins) else len(read.text)
            fine = Words.of(self.tokens(read.text[low:high], True))
            anchors = np.flatnonzero(in_bloom(bits, sequences(running(fine.hashes), WINDOW)))
            words = read.words.first[read.tokens[i] : read.tokens[i + 1]] - low
            same = np.zeros(len(fine.hashes), np.int64)
            for first, last, found in self._known(fine, lengths, bits, anchors, same, same == 0):
                ends = np.searchsorted(words, fine.first[[first, last]], "right") - 1
                yield i, int(ends[0]), int(ends[1]), found

    @staticmethod
    def _known(words, lengths, bits, anchors, row, usable) -> Iterator[tuple[int, int, np.uint64]]:
        """(first, last token, hash) of the known sequences inside one text; long ones start at an anchor."""
        sums, n = running(words.hashes), len(words.hashes)
        for length in lengths:
            if length < WINDOW:
                starts = np.arange(max(0, n - length + 1))
            elif anchors is not None:
                starts = anchors[anchors + length <= n]
            else:
                continue
            last = starts + length - 1
            good = usable[starts] & (row[starts] == row[last])
            if length < LITERAL:
                good &= words.opens[starts].astype(bool) & words.closes[last].astype(bool)
            starts = starts[good]
            hashes = sequences(sums, length, starts)
            known = in_bloom(bits, hashes)
            for p, found in zip(starts[known].tolist(), hashes[known], strict=True):
                yield p, p + length - 1, found


def _runs(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) in turn, so many as make some ``CHARS_AT_ONCE`` characters; a null is empty."""
    run, chars, at = [], 0, 0
    for text in texts:
        run.append(unsharp(text.as_py() or ""))
        chars += len(run[-1])
        if chars >= CHARS_AT_ONCE:
            yield at, run
            run, chars, at = [], 0, at + len(run)
    if run:
        yield at, run


def template_windows(
    rows: DataFrame, key: list[str], bits: bytes | None = None, lengths: Iterable[int] = ()
) -> DataFrame:
    """``key`` columns, kind, n_windows, at, last, hash and slots (values in order) per window of ``rows.text``.

    ``n_windows`` counts the usable windows of the kind in the text.
    With ``bits`` only windows that the Bloom filter knows, and sequences of
    ``lengths`` tokens that it knows. A null or short text has no windows.
    """
    lengths = sorted(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            row, kinds, at, last, hashes, slots, counts = [], [], [], [], [], [], []
            for low, texts in _runs(batch.column(len(key))):
                read = reader.read(texts)
                if read is None:
                    continue
                text, first, end, slot = read.text, read.words.first, read.end, read.slot
                for kind, found in ((TEMPLATE, read.template), (PLAIN, read.plain)):
                    good = np.flatnonzero(found)
                    usable = np.bincount(read.row[good], minlength=len(texts))
                    if bits is not None:
                        good = good[in_bloom(bits, found[good])]
                    rows = read.row[good]
                    row.append(rows + low)
                    kinds.append(np.full(len(good), kind))
                    at.append(good - read.tokens[rows])
                    last.append(at[-1] + WINDOW - 1)
                    counts.append(usable[rows])
                    hashes.append(found[good])
                    for p in good.tolist():
                        places = range(p, p + WINDOW) if kind == TEMPLATE else ()
                        slots.append([text[first[k] : end[k]].lower() for k in places if slot[k]])
                for i, p, q, found in reader.whole(read, lengths, bits) if lengths else ():
                    for column, value in ((row, i + low), (kinds, WHOLE), (at, p), (last, q), (counts, 1)):
                        column.append(np.array([value]))
                    hashes.append(np.array([found]))
                    slots.append([])
            row, kinds, at, last, counts = (
                np.concatenate([np.zeros(0, np.int64), *x]) for x in (row, kinds, at, last, counts)
            )
            picked = batch.select(range(len(key))).take(pa.array(row, pa.int64()))
            flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(kinds, pa.int32()), pa.array(counts, pa.int64()), pa.array(at, pa.int64()),
                 pa.array(last, pa.int64()), pa.array(flat.view(np.int64)), pa.array(slots, pa.list_(pa.string()))],
                names=[*key, "kind", "n_windows", "at", "last", "hash", "slots"],
            )

    keys = ", ".join(f"`{c}` long" for c in key)
    schema = f"{keys}, kind int, n_windows long, at long, last long, hash long, slots array<string>"
    columns = [F.col(c).cast("long").alias(c) for c in key]
    return rows.select(*columns, "text").mapInArrow(run, schema)


def whole_items(benchmark: DataFrame) -> DataFrame:
    """As ``template_windows``: the keys of the items that are looked for whole."""

    schema = "item_id long, kind int, n_windows long, at long, last long, hash long, slots array<string>"
    shape = pa.schema([
        ("item_id", pa.int64()), ("kind", pa.int32()), ("n_windows", pa.int64()), ("at", pa.int64()),
        ("last", pa.int64()), ("hash", pa.int64()), ("slots", pa.list_(pa.string())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            rows = [
                (item, kind, 1, 0, length - 1, int(np.uint64(key).astype(np.int64)), [])
                for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for kind, key, length in reader.own_key(unsharp(text or ""))
            ]
            yield pa.RecordBatch.from_pylist([dict(zip(shape.names, row, strict=True)) for row in rows], shape)

    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, schema)


def _agreeing(hits: list[tuple]) -> set[int]:
    """Places in the item of the hits (at, item_at, item's slots, document's) whose slots agree.

    Each value of the item keeps the value it mostly becomes, and windows
    that say otherwise do not count.
    """
    votes: dict[str, dict[str, int]] = {}
    for _, _, ours, theirs in hits:
        for a, b in zip(ours, theirs, strict=True):
            votes.setdefault(a, {}).setdefault(b, 0)
            votes[a][b] += 1
    means = {a: max(v, key=lambda b: (v[b], b)) for a, v in votes.items()}
    return {p for _, p, ours, theirs in hits if all(means[a] == b for a, b in zip(ours, theirs, strict=True))}


def _groups(hits: list[tuple], item: int) -> Iterator[list[tuple]]:
    """Hits that may be one copy of an item of so many windows.

    Stretches, cut where the next hit is further away than the item is long;
    and, as copies may follow each other directly, hits at like distances from
    their places in the item: the same distance, and a few or up to half an
    item of words more or less.
    """
    cuts = [k for k in range(1, len(hits)) if hits[k][0] - hits[k - 1][0] > item + WINDOW]
    for low, high in zip([0, *cuts], [*cuts, len(hits)], strict=True):
        yield hits[low:high]
    hits = sorted(hits, key=lambda h: h[0] - h[1])
    shifts = np.array([h[0] - h[1] for h in hits])
    centres = np.unique(shifts)
    if len(centres) == 1 and not cuts:
        return
    for width in sorted({0, WINDOW, item // 2}):
        lows, highs = np.searchsorted(shifts, centres - width), np.searchsorted(shifts, centres + width, "right")
        for low, high in dict.fromkeys(zip(lows.tolist(), highs.tolist(), strict=True)):
            yield hits[low:high]


def _longest_run(hits: list[tuple]) -> int:
    """Windows of the longest run of consecutive ones with agreeing slots."""
    best = 0
    shift, start, end = None, 0, 0  # of the run
    means: dict[str, tuple[str, int]] = {}  # value in the document, last seen at
    for at, item_at, ours, theirs in sorted(hits, key=lambda h: (h[0] - h[1], h[0])):
        if at - item_at != shift or at != end:
            shift, start, means = at - item_at, at, {}
        end = at + 1
        here: dict[str, str] = {}
        for a, b in zip(ours, theirs, strict=True):
            if here.setdefault(a, b) != b:
                start = end  # disagrees with itself
            elif a in means and means[a][0] != b:
                start = max(start, means[a][1] + 1)
        for a, b in here.items():
            means[a] = (b, at)
        if start == end:
            means = {}
        if end - start > best:
            best = end - start
    return best


def _best_copy(hits: list[tuple], item: int) -> tuple[float, int, int, int]:
    """(covered share, first, last token, longest run of tokens) of the best copy of an item of so many windows.

    ``hits`` are (at, item_at, item's slots, document's), by place.
    """
    best, place = 0, (0, 0)
    for group in _groups(hits, item):
        if best >= item:
            break
        if len(group) > best and (covered := len(_agreeing(group))) > best:
            places = [h[0] for h in group]
            best, place = covered, (min(places), max(places) + WINDOW - 1)
    windows = _longest_run(hits)
    return best / item, *place, windows + WINDOW - 1 if windows else 0


def _consistent(rows: pd.DataFrame) -> pd.DataFrame:
    """``_best_copy`` of the hits of one kind that a frame has of one document and item."""
    rows = rows.sort_values(["at", "item_at"], kind="stable")
    hits = list(zip(*(rows[c].tolist() for c in ("at", "item_at", "item_slots", "slots")), strict=True))
    found = _best_copy(hits, int(rows["item_windows"].iloc[0]))
    return pd.DataFrame([found], columns=["coverage", "first_token", "last_token", "run"])


def _better(rows: list[tuple]) -> list[tuple]:
    """The kind of windows of one document and one item that covers more of the item."""
    found = []
    for kind in (TEMPLATE, PLAIN, WHOLE):
        some = [r[4:] for r in rows if r[3] == kind]
        if some and kind == WHOLE:
            at, last = some[0][0], some[0][5]
            found.append((1.0, at, last, last + 1 - at))
        elif some:
            found.append(_best_copy([hit[:4] for hit in some], some[0][4]))
    best = max(found, key=lambda f: f[0])  # the first of equals
    return [(*rows[0][:3], *best[:3], max(f[3] for f in found))]


def _spread(places: list[int], costs: list[int]) -> Iterator[int]:
    """Numbers of the cheapest windows such that each run of ``RUN`` tokens has one."""
    span = RUN - WINDOW + 1
    cuts = [k for k in range(1, len(places)) if places[k] != places[k - 1] + 1]
    for low, high in zip([0, *cuts], [*cuts, len(places)], strict=True):
        if high - low < span:
            continue
        best: list[tuple[int, int]] = []  # cost up to a window that is taken, the one taken before
        for k in range(low, high):
            before = min(((best[q - low][0], q) for q in range(max(low, k - span), k)), default=(0, -1))
            best.append((costs[k] + 1 + (before[0] if k - low >= span else 0), before[1] if k - low >= span else -1))
        at = min(range(high - span, high), key=lambda k: best[k - low][0])
        while at >= 0:
            yield at
            at = best[at - low][1]


def _anchors(rows: list[tuple], coverage: float) -> Iterator[tuple]:
    """Windows of one item and kind of which every leak has one, the rarest that do.

    A leak has ``coverage`` of the windows, so it misses too few to miss all of
    any greater number of them; or it has a run, and ``_spread`` leaves none out.
    """
    total = rows[0][4]
    needed = max(1, math.ceil(coverage * total - 1e-9))
    costs = [r[5] for r in rows]
    rarest = sorted(range(len(rows)), key=lambda k: (costs[k], k))[: max(0, total - needed + 1)]
    for k in sorted({*rarest, *_spread([r[2] for r in rows], costs)}):
        yield rows[k][0], rows[k][1], rows[k][3]


def in_groups(
    rows: DataFrame, key: list[str], order: list[str], judge: Callable[[list[tuple]], Iterable[tuple]], shape: str
) -> DataFrame:
    """What ``judge`` gives for the rows of each key, in order; only one key's rows are held at a time.

    Rows are tuples of the columns in their order, which starts with ``key``.
    """
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    schema = pa.schema([(name, types[kind]) for name, kind in (c.split() for c in shape.split(", "))])
    n = len(key)

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:n] != row[:n]:
                    found += judge(held)
                    held = []
                held.append(row)
            if found:
                yield table(found)
                found = []
        if held and (found := list(judge(held))):
            yield table(found)

    return rows.repartition(*key).sortWithinPartitions(*key, *order).mapInArrow(run, shape)


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, tie, item_id, coverage, first_token, last_token, run) of documents that hold items.

    They hold ``coverage`` of an item's windows or a run of ``RUN`` tokens.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other
    columns are not read. ``tie`` is the hash of the text: it tells rows
    without or with the same doc_id apart, and equal rows are found once.
    Null texts and texts without letters and digits hold and leak nothing. No
    rows on either side give no rows.
    """
    items = park(template_windows(benchmark, ["item_id"]).union(whole_items(benchmark)), "items")
    bits = bloom_bits(items, "hash")
    lengths = [r["n"] for r in items.where(F.col("kind") == WHOLE).select((F.col("last") + 1).alias("n")).distinct().collect()]
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), "text")
    # Most documents have no hit and leave nothing behind here.
    hits = park(template_windows(keyed, ["doc_id", "tie"], bits, lengths).drop("n_windows"), "hits")
    # A phrase that many items and documents share must not join each with
    # each: candidates meet in rare windows only, and only theirs are compared.
    seen = hits.groupBy("kind", "hash").agg(F.count("*").alias("n_hits"))
    rated = items.join(seen, ["kind", "hash"], "left").select(
        "item_id", "kind", "at", "hash", "n_windows", F.coalesce("n_hits", F.lit(0)).alias("n_hits")
    )
    anchors = in_groups(
        rated, ["item_id", "kind"], ["at"], lambda rows: _anchors(rows, coverage), "item_id long, kind int, hash long"
    )
    pairs = hits.join(anchors, ["kind", "hash"]).select("doc_id", "tie", "item_id").distinct()
    ours = items.select(
        "item_id", "kind", "hash", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"),
        F.col("n_windows").alias("item_windows"),
    )
    wanted = pairs.withColumnsRenamed({"doc_id": "id", "tie": "row"}).join(ours, "item_id")
    wanted = wanted.withColumnsRenamed({"kind": "item_kind", "hash": "item_hash"})
    theirs = hits.distinct()  # equal rows are one
    same = (
        theirs["doc_id"].eqNullSafe(wanted["id"]) & (theirs["tie"] == wanted["row"])
        & (theirs["kind"] == wanted["item_kind"]) & (theirs["hash"] == wanted["item_hash"])
    )
    met = theirs.join(wanted, same).where(F.size("slots") == F.size("item_slots")).select(
        "doc_id", "tie", "item_id", "kind", "at", "item_at", "item_slots", "slots", "item_windows", "last"
    )
    shape = "doc_id long, tie long, item_id long, coverage double, first_token long, last_token long, run long"
    held = in_groups(met, ["doc_id", "tie", "item_id"], ["kind", "at", "item_at"], _better, shape)
    return held.where((F.col("coverage") >= coverage) | (F.col("run") >= RUN))


def mark_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Per row of ``docs``: doc_id, leaked, n_items, best_item, coverage (0 where nothing leaked)."""
    leaks = find_leaks(docs, benchmark, coverage).groupBy(F.col("doc_id").alias("id"), "tie").agg(
        F.count("*").alias("n_items"), F.max(F.struct("coverage", -F.col("item_id"))).alias("best")
    )
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"))
    same = rows["doc_id"].eqNullSafe(leaks["id"]) & (rows["row"] == leaks["tie"])
    return rows.join(leaks, same, "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("leaked"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        (-F.col("best.col2")).alias("best_item"),
        F.coalesce("best.coverage", F.lit(0.0)).alias("coverage"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    leaks = find_leaks(docs, benchmark, coverage).select(F.col("doc_id").alias("id"), "tie").distinct()
    tie = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["id"]) & (tie == leaks["tie"]), "left_anti")
