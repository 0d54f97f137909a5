"""Groups of records that state the same thing, and the best representative of each group."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alinea.functions import grammar
from alinea.functions.clean import clean_code, fold, grade_years, null_if_blank, strip
from alinea.operators.skew import join_by_heat
from alinea.workspace import materialize

#: Letters of codes that mean the subject of other letters; EF means another subject in the early years.
SUBJECT_LETTERS = {"ART": "AR", "EF": "EDF"}
EARLY_LETTERS = {"EF": "EFPI"}


def _folded(name: str) -> str:
    """A subject's name in the form it is compared in: what ``fold`` and the removal of signs make of it."""
    plain = "".join(c for c in unicodedata.normalize("NFD", name.lower()) if not unicodedata.combining(c))
    return " ".join(re.findall(r"\w+", plain))


def _subject_names() -> dict[str, str]:
    """Folded name to the key that subjects are compared by."""
    names = {_folded(name): SUBJECT_LETTERS.get(letters, letters) for letters, name in grammar.SUBJECT_NAMES.items()}
    return names | {_folded(grammar.EARLY_EF): EARLY_LETTERS["EF"], _folded(grammar.LATER_EF): SUBJECT_LETTERS["EF"]}


#: UTF-8 read as a one-byte encoding: what follows the mark, by the letter it stands for.
_MISREAD = {
    "a": r"\x{80}-\x{85}\x{a1}-\x{a5}\x{20ac}\x{201a}\x{192}\x{201e}", "c": r"\x{87}\x{a7}\x{2021}",
    "e": r"\x{88}-\x{8b}\x{a8}-\x{ab}\x{2c6}\x{2030}\x{160}\x{2039}", "i": r"\x{8c}-\x{8f}\x{ac}-\x{af}\x{152}\x{17d}",
    "n": r"\x{91}\x{b1}\x{2018}", "o": r"\x{92}-\x{96}\x{b2}-\x{b6}\x{2019}\x{201c}\x{201d}\x{2022}\x{2013}",
    "u": r"\x{99}-\x{9c}\x{b9}-\x{bc}\x{2122}\x{161}\x{203a}\x{153}",
}
_TAG = r"<[^<>]*>"
#: Pairs of words up to which they are broadcast.
FEW_PAIRS = 100_000


def plain_words(text: Column) -> Column:
    """The words of a text in folded form, whatever its markup, encoding damage, case and accents.

    Tags, entities, misread UTF-8, soft hyphens, zero-width marks, combining accents, punctuation and
    a code that opens the text are taken away. Null gives null, a text without words an empty list.
    """
    t = _untagged(text)
    entities, misread = F.contains(text, F.lit("&")), F.contains(text, F.lit("Ã")) | F.contains(text, F.lit("Â"))
    t = F.when(entities, _without_entities(t)).otherwise(t)
    t = F.when(misread, _reread(t)).otherwise(t)
    t = F.regexp_replace(fold(t), r"[\x{ad}\x{200b}-\x{200d}\x{2060}\x{feff}]+", "")
    t = F.regexp_replace(t, r"^[^\p{L}\p{N}]*e[ifm][^\p{L}\p{N}]?\d{2}[^\p{L}\p{N}]?[a-z]{2,3}[^\p{L}\p{N}]?\d{2,7}(?![\p{L}\p{N}])", " ")
    return F.regexp_extract_all(t, F.lit(r"([\p{L}\p{N}]+)"), 1)


def _untagged(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, _TAG, " ")).otherwise(text)


def _without_entities(t: Column) -> Column:
    t = F.regexp_replace(t, "&([A-Za-z])(?:acute|grave|circ|tilde|uml|cedil|ring);", "$1")
    t = F.regexp_replace(t, "&ord([fm]);", "$1")
    return F.regexp_replace(t, "&#?[A-Za-z0-9]{2,8};", " ")


def _reread(t: Column) -> Column:
    """Letters that were read as two signs."""
    t = F.regexp_replace(t, r"(?<!\p{L})Ã\x{a0}", "a ")
    for letter, tail in _MISREAD.items():
        t = F.regexp_replace(t, f"Ã[{tail}]", letter)
    return F.regexp_replace(t, r"Â(?=[\x{a0}-\x{bf}])", "")


def text_end(text: Column) -> Column:
    """The last characters of a text without tags and outer blanks: all that tells how it ends."""
    end = strip(_untagged(text))
    # A bracket may hold an ellipsis among blanks; other ends are told by three characters.
    return F.when(end.endswith("]"), F.regexp_replace(F.right(end, F.lit(400)), r"\s+", "")).otherwise(F.right(end, F.lit(3)))


def ends_in_ellipsis(end: Column) -> Column:
    return end.endswith("…") | end.endswith("...") | end.endswith("[…]") | end.endswith("[...]")


def ends_unstopped(end: Column) -> Column:
    """True if a text ends in a letter or digit, without closing punctuation."""
    return F.right(end, F.lit(1)).rlike(r"[\p{L}\p{N}]")


def is_damaged(text: Column) -> Column:
    """True if a text holds markup, entities, misread letters, invisible marks or combining accents."""
    has = lambda c: F.contains(text, F.lit(c))
    return (
        (has("<") & text.rlike(_TAG)) | (has("&") & text.rlike(r"&#?[A-Za-z0-9]{2,8};")) | ((has("Ã") | has("Â")) & text.rlike(r"[ÃÂ][\x{80}-\x{bf}]"))
        | text.rlike(r"[\x{ad}\x{200b}\x{feff}\p{M}]")
    )


def subject_key(subject: Column, code: Column, stage: Column) -> Column:
    """The subject in comparable form; a missing one follows from the code. Null if neither tells."""
    letters = F.regexp_extract(code, "^(?:EI|EF|EM)[0-9]{2}([A-Z]+)", 1)
    early = F.coalesce(F.when(code.isNotNull(), code.startswith("EI")), F.upper(F.trim(stage)) == "EI", F.lit(False))

    def by_letters(c: Column) -> Column:
        pick = lambda m: F.element_at(F.create_map(*(F.lit(x) for kv in m.items() for x in kv)), c)
        return F.coalesce(F.when(early, pick(EARLY_LETTERS)), pick(SUBJECT_LETTERS), c)

    given = null_if_blank(subject)
    name = F.trim(F.regexp_replace(fold(given), r"[^\p{L}\p{N}]+", " "))
    known = F.element_at(F.create_map(*(F.lit(x) for kv in _subject_names().items() for x in kv)), name)
    as_letters = F.when(name.rlike("^[a-z]{2,3}$"), by_letters(F.upper(name)))
    return F.when(given.isNotNull(), F.coalesce(known, as_letters, name)).when(letters != "", by_letters(letters))


def _variants(w: Column) -> Column:
    """A word with up to two of its letters left out."""
    cut = lambda c: F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.left(c, i - 1), F.substring(c, i + 1, F.length(c))))
    one = cut(w)
    return F.array_distinct(F.concat(F.array(w), one, F.flatten(F.transform(one, cut))))


def spelling_candidates(texts: DataFrame, words: str, min_len: int = 5, max_len: int = 48, once: int = 5, twice: int = 20) -> DataFrame:
    """(word, fix, near, n_fix): more frequent words that a rare word may be a slip of.

    Words of letters only, from ``min_len`` to ``max_len`` letters, with the same first letter, one
    slip apart (a letter more, less, wrong, or two swapped) and ``once`` times as frequent, or two
    slips apart (from seven letters) and ``twice`` times as frequent. Frequencies count the texts that
    hold a word. Words that are slips themselves correct nothing. Pairs meet through their first
    letter and words with letters left out, so the work follows the vocabulary.
    """
    vocab = texts.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    vocab = materialize(vocab.filter(F.col("word").rlike(r"^\p{L}+$") & F.length("word").between(min_len, max_len)), "vocabulary")
    keyed = vocab.select("word", "n", F.left("word", F.lit(1)).alias("first"), F.explode(_variants(F.col("word"))).alias("variant"))
    rare = keyed.select("first", "variant", "word", "n")
    more = keyed.filter(F.col("n") >= once).select("first", "variant", F.col("word").alias("fix"), F.col("n").alias("n_fix"))
    met = rare.join(more, ["first", "variant"]).filter(F.col("n_fix") >= once * F.col("n")).select("word", "n", "fix", "n_fix").distinct()
    gap = F.levenshtein("word", "fix")
    letters = lambda c: F.array_sort(F.split(c, ""))
    same_letters = letters(F.col("word")) == letters(F.col("fix"))
    near = (gap == 1) | ((gap == 2) & same_letters)
    far = ((gap <= 3) | ((gap == 4) & same_letters)) & (F.length("word") >= 7) & (F.col("n_fix") >= twice * F.col("n"))
    met = materialize(met.withColumn("near", near).filter(near | far), "near_words")
    # A word that is itself a slip is nobody's correction.
    met = met.join(met.filter("near").select(F.col("word").alias("fix")).distinct(), "fix", "left_anti")
    closest = met.groupBy("word").agg(F.max("near").alias("any_near"))
    return met.join(closest, "word").filter(~F.col("any_near") | F.col("near")).select("word", "fix", "near", "n_fix")


def repair_spelling(texts: DataFrame, text_id: str, words: str) -> DataFrame:
    """(text_id, repaired words): slips replaced by the candidate that fits its neighbours best.

    Candidates are ranked by how often they stand next to the same neighbours in all texts, then by
    frequency. Texts without slips keep their words.
    """
    candidates = materialize(spelling_candidates(texts, words), "slips")
    spots = texts.select(text_id, F.posexplode(words).alias("pos", "word"), F.col(words).alias("w"))
    spots = spots.select(text_id, "pos", "word", F.get("w", F.col("pos") - 1).alias("before"), F.get("w", F.col("pos") + 1).alias("after"))
    slips = materialize(spots.join(candidates, "word"), "spots")
    left, right = F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words))
    pairs = texts.filter(F.size(words) > 1).select(F.explode(F.arrays_zip(left.alias("a"), right.alias("b"))).alias("x")).select("x.a", "x.b")
    # Only neighbours that a candidate would have count: few of those are broadcast, so that other pairs
    # are dropped where they are; else all pairs are counted before the shuffle.
    asked = slips.select(F.explode(F.array(F.struct(F.col("before").alias("a"), F.col("fix").alias("b")), F.struct(F.col("fix").alias("a"), F.col("after").alias("b")))).alias("x"))
    asked = asked.select("x.a", "x.b").filter("a is not null and b is not null").distinct()
    asked = materialize(asked, "asked")
    count = F.count("*").alias("c")
    if asked.count() <= FEW_PAIRS:
        pairs = pairs.join(F.broadcast(asked), ["a", "b"], "left_semi").groupBy("a", "b").agg(count)
    else:
        pairs = pairs.groupBy("a", "b").agg(count).join(asked, ["a", "b"], "left_semi")
    pairs = materialize(pairs, "neighbours")
    scored = slips.join(pairs.toDF("before", "fix", "c1"), ["before", "fix"], "left").join(pairs.toDF("fix", "after", "c2"), ["fix", "after"], "left")
    fit = F.struct(F.coalesce("c1", F.lit(0)) + F.coalesce("c2", F.lit(0)), "n_fix", "fix")
    chosen = scored.groupBy(text_id, "pos").agg(F.max_by("fix", fit).alias("fix"))
    # At most one entry per word of the text.
    maps = chosen.groupBy(text_id).agg(F.map_from_entries(F.collect_list(F.struct("pos", "fix"))).alias("fixes"))
    joined = texts.select(text_id, words).join(maps, text_id, "left")
    repaired = F.transform(words, lambda w, i: F.coalesce(F.try_element_at("fixes", i), w))
    return joined.select(text_id, F.when(F.col("fixes").isNull(), F.col(words)).otherwise(repaired).alias(words))


def complete_cut_texts(keys: DataFrame, block: int = 6) -> DataFrame:
    """(part, key, final): each text with the longer text that a cut one is the beginning of.

    ``keys`` has one row (part, key, cut, open, n) per distinct text; only texts of the same part are
    compared. Texts meet through their first ``block`` words, shorter ones through all their words.
    Of several whole texts that begin with a cut one the one with most records is taken, then the
    first by its words. Where no whole text does, texts that only lack closing punctuation (cut, but
    not open, which an ellipsis is) complete it in the same way, if nothing longer completes them.
    """
    words = F.split("key", " ")
    opening = lambda n: F.array_join(F.slice(words, F.lit(1), n), " ")
    size = F.least(F.size(words), F.lit(block))

    def longer_texts(cut: DataFrame, longer: DataFrame) -> DataFrame:
        short = cut.select("part", size.alias("length"), "key")
        lengths = [F.lit(r["length"]) for r in short.select("length").distinct().collect()]  # at most ``block``
        if not lengths:
            return cut.select("part", "key", F.col("key").alias("longer"), "n").limit(0)
        # Openings meet by their hash; that the longer text begins with the whole cut one is checked then.
        at = lambda n: F.xxhash64(n, opening(n)).alias("opening")
        long = longer.select("part", "n", F.col("key").alias("longer"), F.explode(F.filter(F.array(*lengths), lambda n: n <= F.size(words))).alias("length"), words.alias("w"))
        long = long.select("part", F.xxhash64("length", F.array_join(F.slice("w", F.lit(1), F.col("length")), " ")).alias("opening"), "longer", "n")
        met = short.select("part", "key", at(size)).join(long, ["part", "opening"])
        return met.filter(F.col("longer").startswith(F.concat("key", F.lit(" ")))).select("part", "key", "longer", "n")

    best = F.min_by("longer", F.struct(-F.col("n"), F.col("longer"))).alias("longer")
    by_whole = materialize(longer_texts(keys.filter("cut"), keys.filter("not cut")).groupBy("part", "key").agg(best), "by_whole")
    left = materialize(keys.filter("cut").join(by_whole, ["part", "key"], "left_anti"), "still_cut")
    met = materialize(longer_texts(left, left.filter("not open")), "by_unstopped")
    ends = met.join(met.select("part", F.col("key").alias("longer")).distinct(), ["part", "longer"], "left_anti")
    found = by_whole.unionByName(ends.groupBy("part", "key").agg(best))
    return keys.join(found, ["part", "key"], "left").select("part", "key", F.coalesce("longer", "key").alias("final"))


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws("|", *parts)))


def group_records(records: DataFrame, part: str, words: str, cut: str, open_end: str) -> DataFrame:
    """``records`` with ``group_id``: equal for records of one part whose wording is the same.

    Exact copies are folded together first, so the steps that compare wordings see each text once.
    Records without a part or without words have a null group_id.
    """
    stated = F.col(part).isNotNull() & (F.size(words) > 0)
    named = records.withColumn("text_id", F.when(stated, _digest(F.col(part), F.array_join(words, " "))))
    named = materialize(named, "records")
    texts = named.filter("text_id is not null").groupBy("text_id").agg(F.first(part).alias("part"), F.first(words).alias("words"), F.min(cut).alias("cut"), F.min(open_end).alias("open"), F.count("*").alias("n"))
    texts = materialize(texts, "texts")
    repaired = repair_spelling(texts.select("text_id", "words"), "text_id", "words")
    fixed = materialize(texts.drop("words").join(repaired, "text_id").select("text_id", "part", F.array_join("words", " ").alias("key"), "cut", "open", "n"), "fixed")
    keys = fixed.groupBy("part", "key").agg(F.min("cut").alias("cut"), F.min("open").alias("open"), F.sum("n").alias("n"))
    final = complete_cut_texts(keys)
    groups = fixed.join(final, ["part", "key"]).select("text_id", "n", _digest(F.col("part"), F.col("final")).alias("group_id"))
    groups = materialize(groups, "groups")
    grouped = join_by_heat(named.drop(words), groups, "text_id", "n")
    alone = named.drop(words).filter("text_id is null").withColumn("group_id", F.lit(None).cast("binary"))
    return grouped.unionByName(alone, allowMissingColumns=True).drop("text_id")


def best_of(values: dict[str, tuple[Column, Column]], timestamp: str) -> list[Column]:
    """One aggregate per attribute: the value of the largest (non-null, priority, timestamp, value).

    ``values`` maps an attribute to its value and the priority of its source. Null timestamps come
    last; equal values of equal priority are the same value, so the result is defined on ties.
    """
    return [F.max(F.struct(v.isNotNull().alias("given"), p.alias("priority"), F.col(timestamp).alias("at"), v.alias("value"))).getField("value").alias(name) for name, (v, p) in values.items()]


def prepare_skills(skills: DataFrame) -> DataFrame:
    """The columns that grouping and survivorship of skill records need, from one pass over the table."""
    code = clean_code(null_if_blank(F.col("bncc_code")))
    fields = ["bncc_code", "stage", "grade", "subject", "description_pt", "description_en"]
    filled = sum((F.when(null_if_blank(F.col(c)).isNotNull(), 1).otherwise(0) for c in fields), F.lit(0))
    # One row per row: the texts' ends and clean forms are worked out once for all their uses.
    skills = skills.select("*", F.explode(F.array(F.struct(null_if_blank(F.col("description_pt")).alias("text"), text_end(null_if_blank(F.col("description_pt"))).alias("end")))).alias("_pt"))
    text, end = F.col("_pt.text"), F.col("_pt.end")
    return skills.select(
        "record_id", "loaded_at", code.alias("code"), (code == F.col("bncc_code")).alias("code_as_written"),
        null_if_blank(F.col("grade")).alias("grade"), grade_years(F.col("grade")).alias("years"), null_if_blank(F.col("subject")).alias("subject"),
        text.alias("text_pt"), null_if_blank(F.col("description_en")).alias("text_en"), filled.alias("filled"),
        F.coalesce(is_damaged(text), F.lit(True)).alias("damaged"),
        subject_key(F.col("subject"), code, F.col("stage")).alias("part"), plain_words(text).alias("words"), F.coalesce(ends_in_ellipsis(end) | ends_unstopped(end), F.lit(False)).alias("cut"),
        F.coalesce(ends_in_ellipsis(end), F.lit(False)).alias("open"),
    )


def duplicate_groups(skills: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, survivors) of groups of two or more records that state the same skill of one subject.

    Members: record_id and group_id. Survivors, one per group: survivor_id of the record that covers
    most school years, then has most filled fields, then the latest loaded_at (null last), then the
    lowest record_id; and field by field the best value. Both come from one aggregation whose state
    is one row per group, whatever the group's size. Null or blank texts and unknown subjects
    belong to no group; an empty table gives no rows.
    """
    grouped = materialize(group_records(prepare_skills(skills), "part", "words", "cut", "open").filter("group_id is not null"), "grouped")
    rank = F.struct("years", "filled", F.col("loaded_at").isNotNull(), "loaded_at", -F.col("record_id"))
    whole = (~F.col("cut")).cast("int") * 2 + (~F.col("damaged")).cast("int")
    values = {
        "best_code": (F.col("code"), F.coalesce(F.col("code_as_written").cast("int"), F.lit(0))),
        "best_grade": (F.col("grade"), F.col("years")),
        "best_subject": (F.col("subject"), F.length("subject")),
        "best_text_pt": (F.col("text_pt"), whole),
        "best_text_en": (F.col("text_en"), F.lit(0)),
    }
    survivors = grouped.groupBy("group_id").agg(F.count("*").alias("n"), F.max_by("record_id", rank).alias("survivor_id"), *best_of(values, "loaded_at"))
    return grouped.select("record_id", "group_id"), materialize(survivors.filter("n > 1"), "survivors")


def losers(members: DataFrame, survivors: DataFrame) -> DataFrame:
    """(record_id, survivor_id) for each record that isn't its group's survivor."""
    return join_by_heat(members, survivors.select("group_id", "survivor_id", "n"), "group_id", "n").filter("record_id <> survivor_id").select("record_id", "survivor_id")
