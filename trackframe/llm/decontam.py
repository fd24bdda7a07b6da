"""Benchmark decontamination on question templates.

Texts and benchmark items are cut into tokens and canonicalised: numbers, units
and names become typed placeholders, other words are lower-cased. Windows of
five template tokens are joined by hash. For each document and item the matched
windows are grouped by place; every placeholder must stand for one value all
through (a re-parameterised question changes the values, but consistently),
windows that break this are left out, and the item is found if at least 0.8 of
its windows remain. A capitalised word that opens a text or sentence, or a word all
in capitals between others, may be a name or not: its windows have a key for each reading, on both sides.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .staging import stage
from .textops import U64, character_table, characters, lower_points, map_batches, map_slices, mix, prefix_hash, runs, span_hash, utf8

WINDOW = 5
COVERED = 0.8
# Slots of the filter of benchmark window hashes that goes to every task, as powers of two; it only spares work, the join decides.
FILTER_BITS = (16, 27)

# Unit words, number words with their values, and the placeholder kinds.
UNITS = """mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces
pound pounds lb lbs ton tons ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour
hours day days week weeks month months year years cent cents dollar dollars euro euros percent kmh mph degree degrees
meter meters metre metres kilometer kilometers kilometre kilometres""".split()
NUMBERS = {"zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
           "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16,
           "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50,
           "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90, "hundred": 100, "thousand": 1000,
           "million": 1000000, "billion": 1000000000}
WORD, NUMBER, UNIT, NAME = 0, 1, 2, 3
# Characters after which a sentence may open, and those that belong to a number between digits.
STOPS, JOINTS = ".!?\n\r\"([{*#|\u201c\u201e\u00ab\u00bf\u00a1\u3002", ".,"


def _marked(points: np.ndarray, name: str, of, beyond: bool) -> np.ndarray:
    """``of`` each character; ``beyond`` for those outside the basic plane."""
    table = character_table(name, of)
    return np.where(points < len(table), table[np.minimum(points, len(table) - 1)], beyond)


def _prefix(points: np.ndarray) -> np.ndarray:
    return prefix_hash(mix(points.astype(U64) + U64(21)))


_fixed: dict[str, np.ndarray] = {}


def _fixed_hashes(name: str, texts: list[str]) -> np.ndarray:
    """Token hashes of fixed words, made once a process."""
    if name not in _fixed:
        offsets, points = characters(*utf8(pa.array(texts, pa.large_string())))
        _fixed[name] = span_hash(_prefix(points), offsets[:-1], offsets[1:])
    return _fixed[name]


def _merge(starts, ends, bounds, follows):
    """Token arrays with each token of ``follows`` joined to the one before it; ``heads`` are the tokens left."""
    heads = np.flatnonzero(~follows)
    last = np.concatenate([heads[1:], [len(starts)]]) - 1
    return heads, starts[heads], ends[last], np.searchsorted(heads, bounds)


def tokens(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(kind, value, place, bounds, either)``: value is the token's hash (unit suffixes split off numbers), place its first character.

    Numbers are digits, or number words (``twenty-five`` is one; ``five`` has the value of ``5``). A name is a run of
    capitalised words a space apart; the word that opens a sentence belongs to the run it starts.
    ``either`` marks plain words that may be names: capitalised words alone at the start of a text or
    sentence, and words all in capitals between others.
    """
    offsets, points = characters(offsets, data)
    low = lower_points(points)
    digit = _marked(points, "digit", str.isdecimal, False)
    letter = _marked(points, "letter", lambda c: c.isalpha() or unicodedata.category(c)[0] == "M", True)
    inner = np.zeros(len(points), bool)  # a point or comma between digits belongs to the number
    if len(points) > 2:
        inner[1:-1] = _marked(points[1:-1], "joint", JOINTS.__contains__, False) & digit[:-2] & digit[2:]
    ds, de = runs(digit | inner, offsets)
    ls, le = runs(letter, offsets)
    starts, ends = np.concatenate([ds, ls]), np.concatenate([de, le])
    order = np.argsort(starts, kind="stable")
    number = np.concatenate([np.ones(len(ds), bool), np.zeros(len(ls), bool)])[order]
    starts, ends = starts[order], ends[order]
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.int8), np.zeros(0, U64), starts, bounds, np.zeros(0, bool)
    prefix = _prefix(low)
    value = span_hash(prefix, starts, ends)
    stops = np.concatenate([[0], np.cumsum(_marked(points, "stop", STOPS.__contains__, False) & ~inner)])
    opens = np.zeros(len(starts), bool)  # the text's first token
    opens[bounds[:-1][bounds[:-1] < len(starts)]] = True
    first = opens.copy()
    first[1:] |= stops[starts[1:]] != stops[ends[:-1]]
    beside = np.zeros(len(starts), bool)  # one space or hyphen after the token before
    beside[1:] = (starts[1:] == ends[:-1] + 1) & ~opens[1:]
    gap = points[np.maximum(starts, 1) - 1]
    # A name starts with a capital and has other letters too; a word all in capitals may be one, if those beside it are not
    # (in a text all in capitals they say nothing).
    capitals = np.concatenate([[0], np.cumsum(low != points)])
    big = (low[starts] != points[starts]) & ~number
    full = capitals[ends] - capitals[starts] == ends - starts
    counted = np.isin(value, _fixed_hashes("numbers", list(NUMBERS))) & ~number
    named = big & ~full & ~counted
    full &= big & (ends - starts > 1)
    crowd = np.zeros(len(starts), bool)
    crowd[1:] = full[:-1] & ~opens[1:]
    crowd[:-1] |= full[1:] & ~opens[1:]
    either = full & ~crowd & ~counted
    joined = np.zeros(len(starts), bool)
    joined[1:] = (named[1:] & named[:-1] & ~first[1:] & (gap[1:] == 0x20)) | (counted[1:] & counted[:-1] & ~first[1:] & ((gap[1:] == 0x20) | (gap[1:] == 0x2D)))
    joined &= beside
    lone = first.copy()
    lone[:-1] &= ~joined[1:]
    kind = np.where(number | counted, NUMBER, np.where(named & ~lone, NAME, WORD)).astype(np.int8)
    either |= named & lone
    heads, starts, ends, bounds = _merge(starts, ends, bounds, joined)
    kind, either, opens = kind[heads], either[heads], opens[heads]
    value = span_hash(prefix, starts, ends)
    words = _fixed_hashes("numbers", list(NUMBERS))
    order = np.argsort(words)
    at = np.minimum(np.searchsorted(words[order], value), len(words) - 1)
    alike = words[order][at] == value
    value = np.where(alike, _fixed_hashes("digits", [str(n) for n in NUMBERS.values()])[order][at], value)
    after = np.zeros(len(starts), bool)
    after[1:] = kind[:-1] == NUMBER
    kind[after & ~opens & (kind != NUMBER) & np.isin(value, _fixed_hashes("units", UNITS))] = UNIT
    return kind, value, starts, bounds, either & (kind == WORD)


def windows(offsets: np.ndarray, data: np.ndarray, size: int = WINDOW):
    """``(kind, value, place, bounds, key, text, first, names)``: template window keys with their text number and first token.

    A window without any plain word would match every list of numbers or
    names, so its key keeps the values themselves. A text of fewer tokens has
    one window of all its tokens. Bit j of ``names`` says that the window's token j, a
    word that may be a name, is read as one; a window has a row for each reading
    that leaves a plain word, the plain readings of all windows first.
    """
    kind, value, place, bounds, either = tokens(offsets, data)
    template = np.where(kind == WORD, value, kind.astype(U64))
    counts = np.diff(bounds)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    text = np.repeat(np.arange(len(counts)), n)
    first = np.repeat(bounds[:-1], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)

    def keys(first: np.ndarray, width: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        key, raw, plain = np.zeros(len(first), U64), np.zeros(len(first), U64), np.zeros(len(first), bool)
        free = np.zeros(len(first), np.int64)
        for j in range(size):
            have = j < width
            at = np.minimum(first + j, max(0, len(kind) - 1))
            if len(kind):
                entry = U64(NAME) if names >> j & 1 else template[at]
                key = np.where(have, mix(key * U64(3) + entry), key)
                raw = np.where(have, mix(raw * U64(5) + value[at]), raw)
                if not names >> j & 1:
                    plain |= have & (kind[at] == WORD)
                free |= (have & either[at]).astype(np.int64) << j
        return key, raw, plain, free

    width = np.minimum(size, counts)[text]
    key, raw, plain, free = keys(first, width, 0)
    out = [(np.where(plain, key, raw), text, first, np.zeros(len(first), np.int64))]
    open_ = np.flatnonzero(free)
    for names in range(1, 1 << size):
        fits = open_[free[open_] & names == names]
        if len(fits):
            key, _, plain, _ = keys(first[fits], width[fits], names)
            fits, key = fits[plain], key[plain]
            out.append((key, text[fits], first[fits], np.full(len(fits), names, np.int64)))
    key, text, first, names = (np.concatenate(x) for x in zip(*out))
    return kind, value, place, bounds, key, text, first, names


def _window_rows(df: DataFrame, schema: str, keep=None, size: int = WINDOW, smaller: tuple[int, ...] = ()) -> DataFrame:
    """Rows ``(row, id, n, at, key, kinds, values)`` of the windows whose key passes ``keep``.

    Texts of more tokens than one of the ``smaller`` sizes are cut into windows of that size, too.
    """
    def cut(batch: pa.RecordBatch, size: int, longer: bool = False) -> pa.RecordBatch | None:
        kind, value, _, bounds, key, text, first, names = windows(*utf8(batch.column("text")), size)
        counts = np.diff(bounds)
        n_windows = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
        hit = np.flatnonzero(keep(key)) if keep is not None else np.arange(len(key))
        if longer:  # a text of just that size has such a window already
            hit = hit[counts[text[hit]] > size]
        if not len(hit):
            return None
        ordinal = first - bounds[text]
        width = np.minimum(size, counts)[text[hit]]
        offs = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
        at = np.repeat(first[hit], width) + np.arange(int(width.sum())) - np.repeat(offs[:-1], width)
        named = np.repeat(names[hit], width) >> (np.arange(int(width.sum())) - np.repeat(offs[:-1], width)) & 1
        kinds = np.where(named == 1, NAME, kind[at]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offs), pa.array(x)) for x in (kinds, value[at].view(np.int64))]
        take = pa.array(text[hit])
        return pa.RecordBatch.from_arrays(
            [batch.column("row").take(take), batch.column("id").take(take), pa.array(n_windows[text[hit]].astype(np.int64)),
             pa.array(ordinal[hit].astype(np.int64)), pa.array(key[hit].view(np.int64)), *lists],
            ["row", "id", "n", "at", "key", "kinds", "values"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        parts = [cut(batch, size), *(cut(batch, w, True) for w in smaller)]
        parts = [p for p in parts if p is not None]
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0] if parts else None
    return map_slices(df, "text", run, schema)


def _found(group: list[tuple], n: int) -> tuple[int, bool]:
    """``(windows, changed)`` of the best consistent reading of one place: kept item windows, any placeholder changed.

    Each item value takes the document value it meets most often, no two item
    values of a kind the same one; windows that disagree are left out.
    """
    votes: dict[tuple, Counter] = defaultdict(Counter)
    for _, _, kinds, mine, theirs in group:
        for k, a, b in zip(kinds, theirs, mine):
            if k != WORD:
                votes[k, a][b] += 1
    chosen, used = {}, set()
    for (k, a), c in sorted(votes.items(), key=lambda x: (-max(x[1].values()), x[0])):
        b = next((v for v, _ in sorted(c.items(), key=lambda x: (-x[1], x[0])) if (k, v) not in used), None)
        if b is not None:
            chosen[k, a] = b
            used.add((k, b))
    kept, changed = set(), False
    for _, item_at, kinds, mine, theirs in group:
        if all(k == WORD or chosen.get((k, a)) == b for k, a, b in zip(kinds, theirs, mine)):
            kept.add(item_at)
            changed |= any(k != WORD and a != b for k, a, b in zip(kinds, theirs, mine))
    return len(kept), changed


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            group, best = [], (0, False)
            rows = sorted(((m["at"], m["item_at"], m["kinds"], m["values"], m["item_values"]) for m in r["matches"]), key=lambda m: m[:2])
            for m in [*rows, None]:  # places: runs of matches no further apart than the item is long
                if group and (m is None or m[0] - group[-1][0] > r["n"]):
                    best = max(best, _found(group, r["n"]))
                    group = []
                if m is not None:
                    group.append(m)
            out.append((r["row"], r["id"], r["item_id"], best[0], r["n"], best[1]))
        cols = list(zip(*out)) if out else [[]] * 6
        kinds = [batch.schema.field("row").type, batch.schema.field("id").type, batch.schema.field("item_id").type, pa.int64(), pa.int64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                         ["row", "id", "item_id", "windows", "n", "changed"])


def row_key(id_col: str = "doc_id", text_col: str = "text") -> F.Column:
    """A hash of a row's id and text: equal for equal rows only, null ids included."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).cast("string"))


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", row_col: str | None = None,
                 covered: float = COVERED) -> DataFrame:
    """One row per document row and benchmark item found in it.

    Columns: ``row`` (the value of ``row_col``, by default ``row_key``, which tells texts of one id or of none apart), ``doc_id``,
    ``item_id``, ``windows`` found, ``n_windows`` of the item, ``coverage`` and
    ``changed`` (a placeholder has another value than in the item). Null and empty
    texts and items have no windows and are never found; an item of fewer than five
    tokens is one window of that width, found at any place of a document; windows of different rows never
    add up; rows with equal ids and equal texts (or equal ``row_col``) count as one; items with equal ids are
    taken apart by their text; extra columns are ignored; empty tables give no rows.
    """
    rows = docs.select((F.col(row_col) if row_col else row_key(id_col, text_col)).alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.xxhash64(F.col(item_text).cast("string"), F.col(item_col)).alias("row"), F.col(item_col).alias("id"),
                             F.col(item_text).cast("string").alias("text")).where("text is not null").dropDuplicates(["row"])
    kind_of = lambda df, c: df.schema[c].dataType.simpleString()
    tail = "n bigint, at bigint, key bigint, kinds array<int>, values array<bigint>"
    known = stage(_window_rows(items, f"row bigint, id {kind_of(items, 'id')}, {tail}"), "benchmark-windows")
    # Sixteen slots a window or more, within the filter's bounds.
    bits = min(FILTER_BITS[1], max(FILTER_BITS[0], (16 * known.count()).bit_length()))
    slot = F.shiftrightunsigned("key", 64 - bits)
    table = np.zeros(1 << bits, bool)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(1 << bits, bool)
        for b in batches:
            marks[b.column("s").to_numpy(zero_copy_only=False)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(marks).tobytes()], pa.binary())], ["bits"])
    for r in map_batches(known.select(slot.alias("s")).distinct().coalesce(4), slots, "bits binary").toLocalIterator():
        table |= np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
    spec = docs.sparkSession.sparkContext.broadcast(np.packbits(table))

    def keep(key: np.ndarray) -> np.ndarray:
        at = (key >> U64(64 - bits)).astype(np.int64)
        return (spec.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
    widths = tuple(r["w"] for r in known.select(F.size("values").alias("w")).where(F.col("w") < WINDOW).distinct().collect())
    mine = _window_rows(rows, f"row {kind_of(rows, 'row')}, id {kind_of(rows, 'id')}, {tail}", keep, smaller=widths)
    theirs = known.select(F.col("row").alias("item_row"), F.col("id").alias("item_id"), "n", F.col("at").alias("item_at"),
                          "key", F.col("values").alias("item_values"), F.size("values").alias("width"))
    pairs = (mine.withColumn("width", F.size("values")).drop("n").join(theirs, ["key", "width"])
             .groupBy("row", "id", "item_row", "item_id", "n")
             .agg(F.collect_set(F.struct("at", "item_at", "kinds", "values", "item_values")).alias("matches")))
    # Too few different windows can't reach the share; this keeps chance matches out of the judging.
    pairs = pairs.where(F.size(F.array_distinct(F.transform("matches", lambda m: m["item_at"]))) >= F.lit(covered) * F.col("n"))
    judged = map_batches(pairs.select("row", "id", "item_id", "n", "matches"), _judge,
                         f"row {kind_of(rows, 'row')}, id {kind_of(rows, 'id')}, item_id {kind_of(items, 'id')}, "
                         "windows bigint, n bigint, changed boolean")
    return judged.where(F.col("windows") >= F.lit(covered) * F.col("n")).select(
        "row", F.col("id").alias("doc_id"), "item_id", "windows", F.col("n").alias("n_windows"),
        (F.col("windows") / F.col("n")).alias("coverage"), "changed")
