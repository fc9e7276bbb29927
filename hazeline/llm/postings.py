"""Benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

Texts are cut into words once and stored so. One pass over them counts the
terms that the test phrases use. Each phrase keeps its ``PROBES`` rarest terms; a phrase with a term the corpus lacks
cannot occur and is left out. A second pass stores the postings (document,
term, position) of the probe terms. Phrases are matched from their rarest term
outwards: its postings, shifted by the term's offset, are the candidate starts,
each further list is intersected at its own offset, and what remains is
compared word by word with the document. ``proximity_matches`` uses the same
lists to find the probe terms close together in any order.

A document is named by its id and the hash of its text, so NULL and repeated
ids are told apart; repeated rows get equal results. A NULL text has no words;
an item without words has no window; items with a NULL id count towards hit
words but not towards item lists. Empty tables give no hits. No column but the
id and the text is read, so other names cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored
from .common import free_name, text_key

#: What separates words once A-Z is lowered: all of ASCII but digits and small letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window.
WINDOW = 10
#: Lists that are intersected before a candidate is compared with its document.
PROBES = 3


def lowered(text: Column) -> Column:
    """A-Z to a-z and nothing else. Plain ``lower`` does that to ASCII texts, and faster."""
    small = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(small)


def terms_of(text: Column) -> Column:
    """Words of a text as an array; NULL has none."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), GAP), "")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored (id, key, words) of every row: texts are cut into words once, and all steps read these."""
    return stored(docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), terms_of(F.col(text_col)).alias("words")), "document-words")


def phrases_of(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, phrase, words) of every window of every item; a shorter item is one window."""
    words = items.select(F.col(id_col).alias("item"), terms_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - size, F.lit(0))
    windows = words.select("item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("w", i + 1, size))).alias("words"))
    return windows.select("item", F.concat_ws(" ", "words").alias("phrase"), "words").distinct()


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, n): occurrences in the corpus of each term of the vocabulary that occurs at all."""
    every = docs.select(F.explode("words").alias("term"))
    return every.join(vocabulary, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def with_probes(phrases: DataFrame, counts: DataFrame, probes: int = PROBES) -> DataFrame:
    """(phrase, words, probes): the rarest terms of each phrase with their offsets, rarest first."""
    each = phrases.select("phrase", "words").distinct().select("phrase", "words", F.posexplode("words").alias("offset", "term"))
    ranked = each.join(counts, "term", "left").groupBy("phrase").agg(
        F.first("words").alias("words"), F.min(F.coalesce("n", F.lit(0))).alias("fewest"),
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term"))).alias("by_count"))
    return ranked.where("fewest > 0").select("phrase", "words", F.slice("by_count", 1, probes).alias("probes"))


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Stored postings (term, id, key, pos) of the given terms, or of all."""
    rows = docs.select("id", "key", F.posexplode("words").alias("pos", "term"))
    if terms is not None:
        rows = rows.join(terms, "term", "left_semi")
    return stored(rows.select("term", "id", "key", "pos").sortWithinPartitions("term", "id", "key", "pos"), "postings")


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["key"] == b["key"])


def candidate_starts(index: DataFrame, phrases: DataFrame, probes: int = PROBES) -> DataFrame:
    """(id, key, phrase, words, start) where all probe terms stand at their offsets."""
    first = phrases.withColumn("term", F.col("probes")[0]["term"])
    found = index.join(first, "term").select("id", "key", "phrase", "words", "probes", (F.col("pos") - F.col("probes")[0]["offset"]).alias("start"))
    found = found.where("start >= 0")
    for k in range(1, probes):
        # A phrase with fewer probes than k has passed already.
        probe = F.try_element_at("probes", F.lit(k + 1))
        asked = found.select("*", probe["term"].alias("term"), (F.col("start") + probe["offset"]).alias("pos"))
        more, done = asked.where("term is not null"), asked.where("term is null")
        at = index.select(F.col("id").alias("at_id"), F.col("key").alias("at_key"), F.col("term").alias("at_term"), F.col("pos").alias("at_pos"))
        same = F.col("id").eqNullSafe(F.col("at_id")) & (F.col("key") == F.col("at_key")) & (F.col("term") == F.col("at_term")) & (F.col("pos") == F.col("at_pos"))
        found = more.join(at, same, "left_semi").union(done).drop("term", "pos")
    return found.select("id", "key", "phrase", "words", "start").distinct()


def phrase_matches(docs: DataFrame, index: DataFrame, phrases: DataFrame, probes: int = PROBES) -> DataFrame:
    """(id, key, found): the exact occurrences (phrase, start, n) of each document that has any."""
    starts = stored(candidate_starts(index, phrases, probes), "phrase-starts")
    names = stored(starts.select("id", "key").distinct(), "phrase-documents")
    asked = stored(starts.groupBy("id", "key").agg(F.collect_list(F.struct("phrase", "words", "start")).alias("asked")), "phrase-candidates")
    texts = docs.join(names, same_row(docs, names), "left_semi").dropDuplicates(["id", "key"])
    rows = texts.join(asked, same_row(texts, asked)).select(texts["id"], texts["key"], F.col("words").alias("have"), "asked")
    exact = F.filter("asked", lambda c: F.slice("have", c["start"] + 1, F.size(c["words"])) == c["words"])
    found = F.transform(exact, lambda c: F.struct(c["phrase"].alias("phrase"), c["start"].alias("start"), F.size(c["words"]).alias("n")))
    return rows.select("id", "key", found.alias("found")).where(F.size("found") > 0)


def proximity_matches(index: DataFrame, phrases: DataFrame, span: int) -> DataFrame:
    """(phrase, id, key, pos, width): places of a phrase's rarest term with all its probe terms within ``span`` words, in any order."""
    reach = index.withColumn("cell", F.floor(F.col("pos") / span)).select(
        F.col("id").alias("at_id"), F.col("key").alias("at_key"), F.col("term").alias("at_term"), F.col("pos").alias("at_pos"), F.col("cell").alias("at_cell"))
    first = phrases.withColumn("term", F.col("probes")[0]["term"])
    anchors = index.join(first, "term").select("phrase", "id", "key", "pos", F.array_distinct(F.transform("probes", lambda p: p["term"])).alias("wanted"))
    cell = F.floor(F.col("pos") / span)
    asked = anchors.select("*", F.explode("wanted").alias("term")).select("*", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    same = F.col("id").eqNullSafe(F.col("at_id")) & (F.col("key") == F.col("at_key")) & (F.col("term") == F.col("at_term")) & (F.col("cell") == F.col("at_cell"))
    near = asked.join(reach, same).withColumn("apart", F.abs(F.col("at_pos") - F.col("pos"))).where(F.col("apart") <= span)
    least = near.groupBy("phrase", "id", "key", "pos", "wanted", "term").agg(F.min("apart").alias("apart"))
    whole = least.groupBy("phrase", "id", "key", "pos").agg(F.count(F.lit(1)).alias("n"), F.first(F.size("wanted")).alias("of"), F.max("apart").alias("width"))
    return whole.where("n = of").select("phrase", "id", "key", "pos", "width")


def prepared(docs: DataFrame, items: DataFrame, size: int = WINDOW, probes: int = PROBES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases per item, phrases with probes, index) for keyed documents and a table of items."""
    phrases = stored(phrases_of(items, size), "phrases")
    vocabulary = stored(phrases.select(F.explode("words").alias("term")).distinct(), "phrase-terms")
    counts = stored(term_counts(docs, vocabulary), "term-counts")
    probed = stored(with_probes(phrases, counts, probes), "phrase-probes")
    wanted = stored(probed.select(F.explode("probes").alias("p")).select("p.term").distinct(), "probe-terms")
    return phrases, probed, build_index(docs, wanted)


def matched(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(id, key, n_hit, items) of the documents that contain a window of an item."""
    phrases, probed, index = prepared(docs, items, size)
    found = stored(phrase_matches(docs, index, probed), "phrase-matches")
    covered = F.flatten(F.transform("found", lambda m: F.sequence(m["start"], m["start"] + m["n"] - 1)))
    hits = found.select("id", "key", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    held = found.select("id", "key", F.explode(F.array_distinct(F.transform("found", lambda m: m["phrase"]))).alias("phrase"))
    named = held.join(phrases.select("phrase", "item"), "phrase").groupBy("id", "key").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    named = stored(named, "phrase-items")
    return hits.join(named, same_row(hits, named)).select(hits["id"], hits["key"], "n_hit", "items")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, items) of every document; ``items`` is an array of item ids as sorted strings."""
    rows = keyed(docs, id_col, text_col)
    hits = stored(matched(rows, items, size), "contamination")
    counts = rows.select("id", "key", F.size("words").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return counts.join(hits, same_row(counts, hits), "left").select(
        counts["id"], "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"))


def clean_documents(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without any window of an item; all columns stay as they are."""
    hits = stored(matched(keyed(docs, id_col, text_col), items, size).select("id", "key"), "contaminated")
    key, hit_id, hit_key = (free_name(docs, n) for n in ("text_key", "hit_id", "hit_key"))
    rows = docs.withColumn(key, text_key(F.col(text_col)))
    drop = hits.select(F.col("id").alias(hit_id), F.col("key").alias(hit_key))
    return rows.join(drop, F.col(id_col).eqNullSafe(F.col(hit_id)) & (F.col(key) == F.col(hit_key)), "left_anti").select(*docs.columns)
