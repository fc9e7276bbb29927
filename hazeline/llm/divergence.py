"""How far the sources of a language differ in their use of words.

Terms are counted by sorting pointers. A task takes the Arrow buffer of a
slice of texts as it lies, lower-cases it in place of a copy, marks where words
start, and sorts these pointers by multikey quicksort whose characters are
eight bytes wide: pointers are sorted by the first eight bytes, runs of equal
ones by the next eight, until a run is a single pointer or its words end. Runs
of equal words stay in document order, so the borders of a run give the term's
occurrences and its documents, for each (language, source) apart. Only one row
per run and group leaves the slice; Spark adds them up before and after the
shuffle.

Kept terms and probabilities are plain DataFrame work with decimals, so no sum
can overflow. Sums over pairs of sources run in tiles: at most ``TILE`` sources
against as many others over a block of terms, each term's counts sent to the
tiles they belong to; what terms absent from both sources add is the same each
time and is added at the end.

Defined cases: NULL text, language and source are empty strings; a group
without terms has the probability that the added counts give; a language
without kept terms gives pairs with 0 and no terms; a single source has no
pairs; repeated rows count each; ties rank by the item's bytes; an empty table
gives no rows. Words of any length and texts of any length are taken whole.
Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

#: Fixed values of the audit: documents a kept term is in, count added to each term, scale, ranks of terms.
LEAST_DOCS, ADDED, SCALE, TOP_TERMS = 30, 5, 1_000_000_000, 50
#: Bytes of text sorted at a time.
SLICE = 8 * 1024 * 1024
#: Eight-byte characters compared by sorting; longer words with equal beginnings are compared as bytes.
DEPTH = 8
#: Sources of a tile, and kept terms of a block.
TILE, BLOCK = 64, 4096

#: Lower-cased letter for each byte that belongs to a word, 0 for the others: A-Z, a-z and all of a character beyond ASCII.
LETTER = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
#: The first n bytes of eight.
FIRST = np.array([((1 << (8 * n)) - 1) << (64 - 8 * n) for n in range(9)], np.uint64)


def pointers(low: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each word of lower-cased bytes in which texts begin at ``starts``."""
    inside = low != 0
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = starts[(starts > 0) & (starts < len(low))]
    begin[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    at = np.flatnonzero(begin)
    return at, np.flatnonzero(end) + 1 - at


def sorted_pointers(low: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the pointers by word, earlier ones first among equals, and where in it a new word begins."""
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    windows = np.lib.stride_tricks.as_strided(padded, (len(low) + 1, 8), (1, 1))

    def characters(which: np.ndarray, depth: int) -> np.ndarray:
        rest = np.clip(size[which] - 8 * depth, 0, 8)
        found = windows[np.minimum(at[which] + 8 * depth, len(low))].view(">u8").ravel()
        return found.astype(np.uint64) & FIRST[rest]

    key = characters(np.arange(len(at)), 0)
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = key[1:] != key[:-1]
    for depth in range(1, DEPTH + 1):
        # Whole runs of several pointers with a word that goes on.
        run = np.cumsum(fresh) - 1
        heads = np.flatnonzero(fresh)
        several = np.diff(np.append(heads, len(at))) > 1
        goes_on = np.zeros(len(heads), bool)
        goes_on[run[size[order] > 8 * depth]] = True
        active = np.flatnonzero((several & goes_on)[run])
        if not len(active):
            break
        if depth == DEPTH:
            by_bytes(low, at, size, order, fresh, active, run)
            break
        key = characters(order[active], depth)
        inner = np.lexsort((key, run[active]))
        order[active], key = order[active[inner]], key[inner]
        # Runs keep their places, so a border is where the run or the character changes.
        fresh[active[1:]] |= key[1:] != key[:-1]
    return order, fresh


def by_bytes(low: np.ndarray, at: np.ndarray, size: np.ndarray, order: np.ndarray, fresh: np.ndarray, active: np.ndarray, run: np.ndarray) -> None:
    """Finish runs of long words that agree so far, in place."""
    for places in np.split(active, np.flatnonzero(np.diff(run[active])) + 1):
        members = order[places]
        words = [low[at[i]:at[i] + size[i]].tobytes() for i in members]
        inner = sorted(range(len(words)), key=words.__getitem__)
        order[places] = members[inner]
        for k in range(1, len(inner)):
            fresh[places[k]] = words[inner[k]] != words[inner[k - 1]]


def term_bytes(low: np.ndarray, at: np.ndarray, size: np.ndarray) -> pa.Array:
    """The words at given pointers as an Arrow column."""
    ends = np.cumsum(size)
    places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at - (ends - size), size)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(low[places].tobytes()))


def slice_terms(data: np.ndarray, starts: np.ndarray, group: np.ndarray, groups: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(term, group, occurrences, documents) of a slice of texts; ``group`` numbers each text's language and source."""
    low = LETTER[data]
    at, size = pointers(low, starts)
    order, fresh = sorted_pointers(low, at, size)
    run, text = np.cumsum(fresh) - 1, np.searchsorted(starts, at[order], "right") - 1
    # One entry per run and document, then one per run and group.
    new = fresh.copy()
    new[1:] |= text[1:] != text[:-1]
    places = np.flatnonzero(new)
    times = np.diff(np.append(places, len(order)))
    code, back = np.unique(run[places] * groups + group[text[places]], return_inverse=True)
    n, df = np.bincount(back, times, len(code)).astype(np.int64), np.bincount(back, minlength=len(code))
    heads = order[np.flatnonzero(fresh)]
    return term_bytes(low, at[heads], size[heads]).take(pa.array(code // groups)), code % groups, n, df.astype(np.int64)


def long_text(data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(term, occurrences) of one text longer than a slice, taken in pieces that end between words."""
    total: Counter[str] = Counter()
    lo = 0
    while lo < len(data):
        hi = min(lo + SLICE, len(data))
        while hi < len(data) and LETTER[data[hi]]:
            further = np.flatnonzero(LETTER[data[hi:hi + SLICE]] == 0)
            hi = hi + int(further[0]) if len(further) else min(hi + SLICE, len(data))
        term, _, n, _ = slice_terms(data[lo:hi], np.zeros(1, np.int64), np.zeros(1, np.int64), 1)
        for t, k in zip(term.to_pylist(), n.tolist()):
            total[t] += k
        lo = hi
    return pa.array(list(total), pa.string()), np.array(list(total.values()), np.int64)


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, df) of each slice of (lang, source, text) rows without NULLs."""
    names = ["lang", "source", "term", "n", "df"]
    for batch in batches:
        text = batch.column(2).cast(pa.string())
        ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        number: dict[tuple, int] = {}
        group = np.array([number.setdefault(p, len(number)) for p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.int64)
        langs, sources = (pa.array([p[i] for p in number], pa.string()) for i in (0, 1))
        lo = 0
        while lo < len(text):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + SLICE, "right")) - 1)
            part = data[ends[lo]:ends[hi]]
            if len(part) > SLICE:
                term, n = long_text(part)
                g, df = np.full(len(n), group[lo]), np.ones(len(n), np.int64)
            else:
                term, g, n, df = slice_terms(part, ends[lo:hi] - ends[lo], group[lo:hi], max(len(number), 1))
            at = pa.array(g)
            yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), term, pa.array(n), pa.array(df)], names=names)
            lo = hi


def probability(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * kept)), exact for any counts."""
    wide = "cast({} as decimal(25, 0))"
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * {wide.format(f'{count} + {ADDED}')}) div {wide.format(f'{total} + {ADDED} * {kept}')}")


def ranked(rows: DataFrame) -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the language's other sources, and the terms a source prefers."""

    def plain(name: str, alias: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")).alias(alias)

    rows = docs.select(plain(lang_col, "lang"), plain(source_col, "source"), plain(text_col, "text"))
    parts = rows.mapInArrow(partial_counts, "lang string, source string, term string, n long, df long")
    counts = stored(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "terms-counts")
    kept = stored(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).where(F.col("df") >= LEAST_DOCS).drop("df"), "terms-kept")
    own = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "terms-own")

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0, ["v", "lang_total", "total"])
    # A number for each source of a language, and the probability of a term it never has.
    by_name = Window.partitionBy("lang").orderBy("source")
    groups = stored(groups.withColumn("i", F.row_number().over(by_name) - 1).withColumn("p0", F.when(F.col("v") > 0, probability("0", "total", "v")).otherwise(0)), "terms-groups")

    placed = stored(own.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "i", "v", probability("n", "total", "v").alias("p"), probability("lang_n", "lang_total", "v").alias("q")), "terms-placed")
    terms = placed.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", ranked(terms)).where(F.col("rank") <= TOP_TERMS)
    pairs = pair_sums(placed, groups)
    pairs = pairs.withColumn("rank", ranked(pairs))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))


def tile_sums(rows: pa.Table) -> pa.Table:
    """Sums of absolute differences of the pairs of two tiles over one block of terms, and the terms either tile has."""
    lang, one, two = (rows.column(c)[0].as_py() for c in ("lang", "one", "two"))
    i, p, term = rows.column("i").to_numpy(), rows.column("p").to_numpy(), rows.column("term")
    base = term.is_null().to_numpy()
    sources, column = np.unique(i[base], return_inverse=True)
    p0 = np.empty(len(sources), np.int64)
    p0[column] = p[base]
    words = term.filter(pa.array(~base)).combine_chunks().dictionary_encode() if not base.all() else None
    table = np.tile(p0, (len(words.dictionary) if words is not None else 0, 1))
    if words is not None:
        table[words.indices.to_numpy(), np.searchsorted(sources, i[~base])] = p[~base]
    left, right = (np.flatnonzero(sources // TILE == t) for t in (one, two))
    out = [np.abs(table[:, [a]] - table[:, right]).sum(0) for a in left]
    a, b = np.repeat(sources[left], len(right)), np.tile(sources[right], len(left))
    n = len(a)
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()),
                     "value": pa.array(np.concatenate(out) if n else [], pa.int64()), "seen": pa.array(np.full(n, len(table)), pa.int64())})


def pair_sums(placed: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's sources."""
    blocks = F.greatest(F.ceil(F.col("v") / BLOCK), F.lit(1)).cast("long")
    tiles = groups.groupBy("lang").agg(F.floor(F.max("i") / TILE).cast("int").alias("last"))

    def dealt(rows: DataFrame) -> DataFrame:
        """Each row once for every tile its own tile is compared with, itself included."""
        tile, other = F.floor(F.col("i") / TILE).cast("int"), F.explode(F.sequence(F.lit(0), F.col("last")))
        dealt = rows.join(tiles, "lang").withColumn("tile", tile).withColumn("other", other)
        return dealt.select("lang", "block", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "i", "p", "term")

    own = placed.withColumn("block", F.pmod(F.xxhash64("term"), blocks))
    base = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    base = base.select("lang", "i", F.col("p0").alias("p"), F.lit(None).cast("string").alias("term"), "block")
    rows = dealt(own.select("lang", "i", "p", "term", "block")).unionByName(dealt(base))
    found = rows.groupBy("lang", "block", "one", "two").applyInArrow(tile_sums, "lang string, a int, b int, value long, seen long")
    sums = stored(found.where("a < b").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen")), "terms-pairs")
    both = sums.union(sums.select("lang", "b", "a", "value", "seen"))
    of_a = groups.select("lang", F.col("i").alias("a"), "source", "v", F.col("p0").alias("pa"))
    of_b = groups.select("lang", F.col("i").alias("b"), F.col("source").alias("item"), F.col("p0").alias("pb"))
    value = F.col("value") + (F.col("v") - F.col("seen")) * F.abs(F.col("pa") - F.col("pb"))
    return both.join(of_a, ["lang", "a"]).join(of_b, ["lang", "b"]).select("lang", "source", "item", value.alias("value"))
