"""Benchmark decontamination by templates.

A text is read as a sequence of tokens: words in lower case, and typed
placeholders for numbers, names and units.  A question with other numbers or
names in it has the same template.  Windows of the templates are joined by
hash; along a passage that matches, every value of the benchmark's placeholders
must stand for one value of the document throughout.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailgauge.llm.common import map_texts, numbered, position, strings
from mailgauge.sources.scratch import land

WINDOW = 5
# A window needs so many plain words; placeholders alone are no evidence.
PLAIN_WORDS = 3
# Share of an item's windows that a document must have.
COVERAGE = 0.5
# Items with fewer windows are looked for word for word as well.
FEW_WINDOWS = 5
# Size of the bit map of benchmark windows sent to all tasks: 2**27 bits are 16 MiB, whatever the benchmark's size.
FILTER_BITS = 27
# Characters worked on at a time.
RUN_CHARS = 1 << 19

# Units that a placeholder stands for.
UNITS = """
    mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres
    mg g kg lb lbs oz ton tons gram grams kilogram kilograms pound pounds ounce ounces
    ml l liter liters litre litres gallon gallons cup cups pint pints
    s sec min h hr hrs second seconds minute minutes hour hours day days week weeks month months year years
    dollar dollars euro euros cent cents usd eur gbp percent degree degrees kmh mph
""".split()

NUMBER, UNIT, NAME, PLAIN, STOP = range(5)

# Readings of an item: capitalised words that begin a sentence as words, or as names; all names as words; word for word.
_AS_WORDS, _AS_NAMES, _NAMELESS, _VERBATIM = range(4)

# Kinds of characters: letters, digits, ends of sentences, signs that are units of their own, and letters of scripts that
# put no blanks between words, each a token.
_OTHER, _LETTER, _DIGIT, _END, _SIGN, _UNSPACED = range(6)
_SIGNS = "%$€£°"
_BETWEEN_DIGITS = ".,/:"
# Scripts without blanks between words, by how the names of their characters begin, and their full stop.
_UNSPACED_SCRIPTS = ("CJK ", "HIRAGANA ", "KATAKANA ", "THAI ", "LAO ", "KHMER ", "MYANMAR ", "TIBETAN ", "YI ")
_ENDS = ".!?。！？"
# Characters in the table; those beyond are looked up one by one, as texts have few of them.
_CHARS = 1 << 16


def _kind_of_char(char: str) -> int:
    if char.isalpha():
        return _UNSPACED if unicodedata.name(char, "").startswith(_UNSPACED_SCRIPTS) else _LETTER
    if char.isdecimal():
        return _DIGIT
    return _END if char in _ENDS else _SIGN if char in _SIGNS else _OTHER


def _tables_of(codes: Iterable[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    chars = [chr(c) for c in codes]
    kind = np.array([_kind_of_char(c) for c in chars], dtype=np.int8)
    lower = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars], dtype=np.uint64)
    return kind, lower, np.array([c.isupper() for c in chars], dtype=bool)


@cache
def _char_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, lower case, whether upper case) by code point."""
    return _tables_of(range(_CHARS))


def _looked_up(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, lower case, whether upper case) of each character."""
    tables = _char_tables()
    beyond = np.flatnonzero(code >= _CHARS)
    found = tuple(table[np.minimum(code, _CHARS - 1)] for table in tables)
    if len(beyond):
        distinct, which = np.unique(code[beyond], return_inverse=True)
        for values, own in zip(found, _tables_of(distinct.tolist())):
            values[beyond] = own[which]
    return found


# A character's place in its token stands above the bits of the character.
_PLACE = np.uint64(21)


def _mixed(x: np.ndarray) -> np.ndarray:
    # A mixing step of 64 bits with odd multipliers.
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tokens(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first character, kind, hash of the lower case) of the tokens of a text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind, lower, upper = _looked_up(code)
    digit = kind == _DIGIT
    # A point or the like between digits belongs to the number.
    between = np.flatnonzero(np.isin(code[1:-1], [ord(c) for c in _BETWEEN_DIGITS]) & digit[:-2] & digit[2:]) + 1
    kind[between] = _DIGIT
    edge = np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == _UNSPACED)])
    begin = np.flatnonzero(edge & (kind != _OTHER))
    if not len(begin):
        return begin, np.empty(0, dtype=np.int8), np.empty(0, dtype=np.uint64)
    inside = np.flatnonzero(kind != _OTHER)
    first = np.searchsorted(inside, begin)
    length = np.diff(np.append(first, len(inside)))
    place = np.arange(len(inside)) - np.repeat(first, length)
    hashes = np.add.reduceat(_mixed(lower[inside] + (place.astype(np.uint64) << _PLACE)), first)
    capitals = np.add.reduceat(upper[inside].astype(np.int32), first)
    by_char = kind[begin]
    out = np.full(len(begin), PLAIN, dtype=np.int8)
    out[(by_char == _LETTER) & (length > 1) & (capitals == 1) & upper[begin]] = NAME
    out[np.isin(hashes, _unit_hashes()) & (by_char == _LETTER) | (by_char == _SIGN)] = UNIT
    out[by_char == _DIGIT] = NUMBER
    out[by_char == _END] = STOP
    return begin, out, hashes


@cache
def _unit_hashes() -> np.ndarray:
    _, lower, _ = _char_tables()
    of = lambda unit: _mixed(lower[[ord(c) for c in unit]] + (np.arange(len(unit), dtype=np.uint64) << _PLACE))
    return np.array([of(unit).sum(dtype=np.uint64) for unit in UNITS], dtype=np.uint64)


def _runs(text: str) -> Iterator[tuple[int, str]]:
    """(position, run) of a text cut at blanks; only a run without any is cut elsewhere."""
    at = 0
    while at < len(text):
        end = at + RUN_CHARS
        if end < len(text):
            blank = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end), text.rfind("\0", at + 1, end))
            end = blank if blank > 0 else end
        yield at, text[at:end]
        at = end


def templates(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, template hash, hash of the value, kind) of each token but ends of sentences.

    A capitalised word is a name unless a sentence begins with it.
    """
    return _read_tokens(texts)[:4]


def _read_tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``templates``, and whether a token is a capitalised word that begins a sentence."""
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    found = [(at + begin, kind, value) for at, run in _runs("\0".join(texts)) for begin, kind, value in [_tokens(run)]]
    if not found:
        none = np.empty(0, dtype=np.uint64)
        return np.empty(0, dtype=np.int64), none, none, np.empty(0, dtype=np.int8), np.empty(0, dtype=bool)
    begin, kind, value = (np.concatenate(x) for x in zip(*found))
    row = np.searchsorted(starts, begin, side="right") - 1
    begins = np.concatenate([[True], (kind[:-1] == STOP) | (row[1:] != row[:-1])])[: len(kind)]
    initial = begins & (kind == NAME)
    kind[initial] = PLAIN
    kept = kind != STOP
    row, kind, value = row[kept], kind[kept], value[kept]
    return row, _slots(kind, value), value, kind, initial[kept]


def _slots(kind: np.ndarray, value: np.ndarray) -> np.ndarray:
    return np.where(kind == PLAIN, value, (kind + 1).astype(np.uint64))


def windows(row: np.ndarray, slot: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the windows within one text that hold enough plain words."""
    n = len(slot) - WINDOW + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    plain = np.zeros(n, dtype=np.int8)
    for k in range(WINDOW):
        # Fixed value: an odd multiplier that spreads the bits (golden ratio).
        h = (h ^ slot[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        plain += kind[k : k + n] == PLAIN
    at = np.flatnonzero((plain >= PLAIN_WORDS) & (row[:n] == row[WINDOW - 1 :]))
    return at, h[at]


def verbatim_windows(row: np.ndarray, value: np.ndarray, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of all windows of so many tokens within one text, none of them masked."""
    n = len(value) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    h = np.full(n, _mixed(np.array([length], dtype=np.uint64))[0])
    for k in range(length):
        h = (h ^ value[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    at = np.flatnonzero(row[:n] == row[length - 1 :])
    return at, h[at]


_WINDOW_ROWS = "id long, row long, variant int, pos int, n int, hash long, length int, slots array<struct<at: int, value: long>>"


def _window_rows(piece: pa.RecordBatch, variant, row, at, hashes, kind, value, totals, length=WINDOW) -> pa.RecordBatch:
    """Rows for windows of a piece's texts; slots are the values of a window's placeholders by offset."""
    offset = np.arange(WINDOW)
    kind = np.append(kind, np.full(WINDOW, PLAIN, dtype=np.int8))  # a short text's windows reach beyond it
    is_slot = kind[at[:, None] + offset] != PLAIN
    window, place = np.nonzero(is_slot)
    ends = np.concatenate([[0], np.cumsum(is_slot.sum(axis=1))]).astype(np.int32)
    values = value[at[window] + place].view(np.int64)
    slots = pa.StructArray.from_arrays([pa.array(place.astype(np.int32)), pa.array(values)], ["at", "value"])
    text = row[at]
    begins = np.searchsorted(row, np.arange(piece.num_rows))
    return pa.RecordBatch.from_pydict(
        {
            "id": piece.column(0).take(pa.array(text)),
            "row": piece.column(1).take(pa.array(text)),
            "variant": pa.array(np.full(len(at), variant, dtype=np.int32)),
            "pos": pa.array((at - begins[text]).astype(np.int32)),
            "n": pa.array(totals[text].astype(np.int32)),
            "hash": pa.array(hashes.view(np.int64)),
            "length": pa.array(np.full(len(at), length, dtype=np.int32)),
            "slots": pa.ListArray.from_arrays(pa.array(ends), slots),
        }
    )


def _read_items():
    """Turns pieces of benchmark items (id, row, text) into the windows of each reading that an item has."""

    def work(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, slot, value, kind, initial = _read_tokens(strings(piece.column(2)))
        everyone = np.ones(piece.num_rows, dtype=bool)
        as_names = np.where(initial, NAME, kind).astype(np.int8)
        nameless = np.where(kind == NAME, PLAIN, kind).astype(np.int8)
        holding = lambda tokens: np.bincount(row[tokens], minlength=piece.num_rows) > 0
        for variant, read, takes_part in (
            (_AS_WORDS, kind, everyone),
            (_AS_NAMES, as_names, holding(initial)),
            (_NAMELESS, nameless, holding(kind == NAME)),
        ):
            at, hashes = windows(row, _slots(read, value), read)
            totals = np.bincount(row[at], minlength=piece.num_rows)
            if variant == _AS_WORDS:
                few = totals < FEW_WINDOWS
            own = takes_part[row[at]]
            yield _window_rows(piece, variant, row, at[own], hashes[own], read, value, totals)
        lengths = np.bincount(row, minlength=piece.num_rows)
        for length in range(1, WINDOW + 1):
            at, hashes = verbatim_windows(row, value, length)
            own = few[row[at]] & (lengths[row[at]] >= WINDOW if length == WINDOW else lengths[row[at]] == length)
            totals = np.bincount(row[at[own]], minlength=piece.num_rows)
            yield _window_rows(piece, _VERBATIM, row, at[own], hashes[own], np.full(len(row), PLAIN, np.int8), value, totals, length)

    return work


def _read_documents(allowed):
    """Turns pieces of documents into the windows that are of an item; ``allowed``: a bit map of hashes, lengths read word for word."""

    def prepare():
        bits, lengths = allowed.value
        bitmap = np.frombuffer(bits, dtype=np.uint8)

        def known(at, hashes):
            cell = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            hit = (bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
            return at[hit], hashes[hit]

        def work(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            row, slot, value, kind, initial = _read_tokens(strings(piece.column(2)))
            totals = np.zeros(piece.num_rows, dtype=np.int64)
            at, hashes = known(*windows(row, slot, kind))
            yield _window_rows(piece, _AS_WORDS, row, at, hashes, kind, value, totals)
            if initial.any():
                read = np.where(initial, NAME, kind).astype(np.int8)
                at, hashes = windows(row, _slots(read, value), read)
                before = np.concatenate([[0], np.cumsum(initial)])
                other = before[at + WINDOW] > before[at]  # the rest are as above
                at, hashes = known(at[other], hashes[other])
                yield _window_rows(piece, _AS_NAMES, row, at, hashes, read, value, totals)
            for length in lengths:
                at, hashes = known(*verbatim_windows(row, value, length))
                if length < WINDOW:  # one place tells as much as all
                    _, first = np.unique(np.stack([row[at].astype(np.int64), hashes.view(np.int64)]), axis=1, return_index=True)
                    at, hashes = at[first], hashes[first]
                yield _window_rows(piece, _VERBATIM, row, at, hashes, np.full(len(row), PLAIN, np.int8), value, totals)

        return work

    return prepare


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, variant, item_pos, item_windows, hash, item_slots of all items.  Of equal texts the least item_id stands
    for all (see ``equal_items``).

    Each reading of an item counts its own windows.  An item with few windows
    is read word for word too; one of fewer than WINDOW tokens is a single window then.
    """
    named = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")).dropna()
    items = named.groupBy("text").agg(F.min("id").alias("id")).select("id", F.lit(0).cast("long").alias("row"), "text")
    found = map_texts(items, _WINDOW_ROWS, _read_items, "text")
    return found.select(
        F.col("id").alias("item_id"),
        "variant",
        F.col("pos").alias("item_pos"),
        F.col("n").alias("item_windows"),
        "hash",
        "length",
        F.col("slots").alias("item_slots"),
    ).distinct()


def equal_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, same_id: of every item with an id and a text, the least id of those with that text."""
    named = benchmark.select(F.col(item_id).cast("long").alias("same_id"), F.col(text).alias("text")).dropna()
    least = named.groupBy("text").agg(F.min("same_id").alias("item_id"))
    return named.join(least, "text").select("item_id", "same_id").distinct()


def rarest_windows(items: DataFrame, coverage: float) -> DataFrame:
    """item_id, variant, hash: windows of which a text that holds the reading has at least one.

    Of n windows, k are needed.  Who has k of them has one of any n - k + 1, and those that the fewest items share are
    chosen, so a phrase that many items begin with brings no pairs.
    """
    shared = items.groupBy("hash").agg(F.count("*").alias("items"))
    rarest = Window.partitionBy("item_id", "variant").orderBy("items", "hash", "item_pos")
    left_over = F.col("item_windows") - F.ceil(_needed(coverage) * F.col("item_windows"))
    places = items.join(shared, "hash").withColumn("place", F.row_number().over(rarest))
    return places.filter(F.col("place") <= left_over + 1).select("item_id", "variant", "hash").distinct()


def _needed(coverage: float) -> Column:
    """Share of its windows that a reading needs: all of one that is looked for word for word."""
    return F.when(F.col("variant") == _VERBATIM, 1.0).otherwise(float(coverage))


def window_filter(windows: DataFrame) -> bytes:
    """A bit map of the windows' hashes, put together from words of 64 bits: FILTER_BITS bounds its size."""
    cell = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    words = (
        windows.select(cell.alias("cell"))
        .groupBy(F.shiftright("cell", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(cell & 63 AS INT))")).alias("bits"))
    )
    bitmap = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for batch in words.toArrow().to_batches():
        bitmap[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    return bitmap.tobytes()


def verbatim_lengths(windows: DataFrame) -> list[int]:
    """How many tokens the windows have that items are looked for with word for word."""
    verbatim = windows.filter(F.col("variant") == _VERBATIM)
    return [r.length for r in verbatim.select("length").distinct().orderBy("length").collect()]


_ALIGNMENT = ("id", "row", "item_id", "variant", "shift")


def contaminated_rows(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """id, row, item_id, n_windows, item_windows, n_slots, n_conflicts of documents (id, row, text) that hold an item.

    A document is compared with the items of which it has one of the rarest windows (see ``rarest_windows``), and with
    all of their windows then.  Windows of one alignment (document position less item position) count
    together as far as their slots agree: each value of the item's placeholders stands for one value of the document, the one
    that most windows have it for.  Windows that conflict with that are left out, and counted.  All
    alignments add up, so a passage with an insertion is found too.
    """
    items = land(benchmark_windows(benchmark))
    allowed = docs.sparkSession.sparkContext.broadcast((window_filter(items), verbatim_lengths(items)))
    found = map_texts(docs, _WINDOW_ROWS, _read_documents(allowed), "text")
    # Looked at twice, and stored so that adaptive execution can split a window that very many documents have.
    found = land(found.select("id", "row", "pos", "hash", "slots"))
    probes = land(rarest_windows(items, coverage))
    pairs = land(found.select("id", "row", "hash").join(probes, "hash").select("id", "row", "item_id", "variant").distinct())
    wanted = pairs.join(items, ["item_id", "variant"])
    there = found.select(F.col("id").alias("_id"), F.col("row").alias("_row"), "pos", "hash", "slots")
    same = wanted["id"].eqNullSafe(there["_id"]) & (wanted["row"] == there["_row"]) & (wanted["hash"] == there["hash"])
    met = wanted.join(there, same).select(
        "id",
        "row",
        "item_id",
        "variant",
        "item_windows",
        "item_pos",
        (F.col("pos") - F.col("item_pos")).alias("shift"),
        F.zip_with(
            "item_slots", "slots", lambda i, d: F.struct(i.value.alias("item"), d.value.alias("doc"))
        ).alias("pairs"),
    )
    met = land(met)
    # On one alignment an item's positions occur once each, so what is gathered is no longer than the item.
    aligned = met.groupBy(*_ALIGNMENT).agg(
        F.max("item_windows").alias("item_windows"),
        F.collect_set("item_pos").alias("places"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    agree = F.size("pairs") == F.size(F.array_distinct(F.col("pairs.item")))
    aligned = land(aligned.withColumn("agree", agree))
    # A passage may occur very often in a document; its places are counted, not gathered.
    places = (
        aligned.filter("agree")
        .select(
            "id", "row", "item_id", "variant", "item_windows", F.size("pairs").alias("slots"), F.explode("places").alias("at")
        )
        .withColumn("dropped", F.lit(False))
        .unionByName(_without_conflicts(met, aligned.filter("NOT agree")))
        .groupBy("id", "row", "item_id", "variant", "at")
        .agg(
            F.max("item_windows").alias("item_windows"),
            F.max("slots").alias("slots"),
            F.min("dropped").alias("dropped"),
        )
    )
    kept = F.col("n_windows") >= _needed(coverage) * F.col("item_windows")
    held = (
        places.groupBy("id", "row", "item_id", "variant")
        .agg(
            F.count_if(~F.col("dropped")).alias("n_windows"),
            F.max("item_windows").cast("long").alias("item_windows"),
            F.max("slots").cast("long").alias("n_slots"),
            F.count_if("dropped").alias("n_conflicts"),
        )
        .filter(kept & (F.col("n_windows") > 0))
    )
    return held.groupBy("id", "row", "item_id").agg(_best()).select("id", "row", "item_id", "best.*")


def _without_conflicts(met: DataFrame, aligned: DataFrame) -> DataFrame:
    """Places of alignments whose slots do not agree, and which of them conflict with the commonest reading of a slot."""
    keys = aligned.select(*[F.col(k).alias(f"_{k}") for k in _ALIGNMENT])
    same = [met[k].eqNullSafe(keys[f"_{k}"]) for k in _ALIGNMENT]
    windows = met.join(keys, same, "left_semi")
    slots = windows.select(*_ALIGNMENT, "item_pos", F.explode(F.array_distinct("pairs")).alias("pair")).select(
        *_ALIGNMENT, "item_pos", "pair.item", "pair.doc"
    )
    by_value = slots.groupBy(*_ALIGNMENT, "item", "doc").agg(F.countDistinct("item_pos").alias("n"))
    commonest = by_value.groupBy(*_ALIGNMENT, "item").agg(F.max_by("doc", F.struct("n", "doc")).alias("commonest"))
    by_alignment = commonest.groupBy(*_ALIGNMENT).agg(
        F.map_from_entries(F.collect_list(F.struct("item", "commonest"))).alias("stands_for")
    )
    other = by_alignment.toDF(*[f"_{k}" for k in _ALIGNMENT], "stands_for")
    matched = windows.join(other, [windows[k].eqNullSafe(other[f"_{k}"]) for k in _ALIGNMENT])
    conflicts = F.exists("pairs", lambda p: F.element_at("stands_for", p["item"]) != p["doc"])
    return matched.select(
        "id",
        "row",
        "item_id",
        "variant",
        "item_windows",
        F.size("stands_for").alias("slots"),
        F.col("item_pos").alias("at"),
        conflicts.alias("dropped"),
    )


def _best() -> Column:
    """Of several rows for an item, the one that covers most of it, with its own counts."""
    figures = ("n_windows", "item_windows", "n_slots", "n_conflicts")
    best = F.max(F.struct((F.col("n_windows") / F.col("item_windows")).alias("share"), *figures))
    return F.struct(*[best[f].alias(f) for f in figures]).alias("best")


def _identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A text's hash tells rows of one id apart; rows of equal id and text have equal results."""
    return docs.select(
        F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("text")
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """doc_id, item_id, n_windows, item_windows, coverage, n_slots, n_conflicts: what benchmark items documents hold.

    Documents without any item have no row, those with one of several equal items a row for each.  Null and empty texts hold
    nothing, an empty benchmark is held by none.  Rows repeated with equal id
    and text give one row; a null id is kept as null.  Long texts are read in
    runs, whole.
    """
    rows = contaminated_rows(_identified(docs, doc_id, text), benchmark, coverage)
    by_text = rows.groupBy(F.col("id").alias("doc_id"), "item_id").agg(_best())
    return (
        by_text.join(equal_items(benchmark), "item_id")
        .select("doc_id", F.col("same_id").alias("item_id"), "best.*")
        .withColumn("coverage", F.col("n_windows") / F.col("item_windows"))
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they are."""
    found = contaminated_rows(_identified(docs, doc_id, text), benchmark, coverage)
    held = land(found.select("id", "row").distinct())
    rows = numbered(docs)
    same_id = F.col(position(docs, doc_id)).cast("long").eqNullSafe(F.col("id"))
    same_text = F.xxhash64(F.col(position(docs, text))) == F.col("row")
    return rows.join(held, same_id & same_text, "left_anti").toDF(*docs.columns)
