"""Spelling variant grouping: words one edit apart, found in the sorted permuterm rotations of all words.

Every word gets a terminator and is rotated. The rotation of `w$` that begins behind the character at place i ends with that
character; without it, it is the word with place i skipped: `(behind i)$(before i)`. Words that differ by a replacement at i
share this skipped form, and a word that lacks the character has it as one of its own whole rotations. So in the sorted
rotations all partners of a word lie in the ranges of its skipped forms. A range holds at most one entry for each letter of
the alphabet (90) and one whole word, however large the vocabulary is; one window scans it, and each entry names its best
partner and how many it has, never the pairs. A character within a run of equal ones gives the same shorter word at
every place of the run; only the first place counts there, so each partner is met in exactly one range.

Rotations of a word take the square of its length. Skipped forms above TEXT_LETTERS are therefore named by their place and the
128-bit digests of the parts before and behind it, computed from both ends in one walk; all else is the same.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmart.llm.shared import stored

#: The contract's values: letters and occurrences a word needs, how many times more often its form occurs, and the divisor
#: of the checksums of runs that lose a letter.
LEAST_LETTERS, LEAST_COUNT, TIMES, SPARED = 5, 3, 2, 97
#: Terminator; no letter.
END = "$"
#: Longest skipped form written out as text.
TEXT_LETTERS = 64
#: A run of the letters A-Z, a-z and U+00C0 to U+00FF in UTF-8, after A-Z was lower-cased; and a byte that ends every run.
RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
BREAK = re.compile(rb"[^a-z\x80-\xff]")
PIECE_BYTES = 1 << 20
TASK_WORDS = 100_000
ENTRY = "key string, edited string, opens boolean, id string, n long"


def run_pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in pieces that don't cut a run, so that the runs of a huge text are never all held."""
    at = 0
    while len(text) - at > size:
        end = BREAK.search(text, at + size)
        if end is None:
            break
        yield text[at : end.end()]
        at = end.end()
    yield text[at:]


def spared(doc: bytes, run: bytes) -> bytes:
    """The word of a run: the run itself, or without one of its letters where SPARED divides the checksum."""
    check = zlib.crc32(run, zlib.crc32(doc))
    if check % SPARED:
        return run
    letters = run.decode()
    k = check % len(letters)
    return (letters[:k] + letters[k + 1 :]).encode()


def corpus_words(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the distinct words of all whole texts and how often each occurs. A null doc_id counts as no digits.

    Each task adds up its own words (at most TASK_WORDS distinct ones at a time) before they are exchanged.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.binary()).cast(pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"]
            )
            words.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                text = text.as_buffer()
                if text is None:
                    continue
                mark = b":" if doc.as_py() is None else b"%d:" % doc.as_py()
                for piece in run_pieces(text.to_pybytes().lower()):
                    for run, n in Counter(RUN.findall(piece)).items():
                        if len(run) >= least_letters:
                            words[spared(mark, run)] += n
                    if len(words) >= TASK_WORDS:
                        yield flush()
        if words:
            yield flush()

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(count, "word string, n long")
    return (
        rows.filter(F.length("word") >= least_letters).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)
    )


def _short_entries(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Skipped forms and whole rotations written out as text."""
    word, size = F.col("word"), F.length("word")

    def behind(i: Column) -> Column:
        return F.substring(word, i, size)

    def before(i: Column) -> Column:
        return F.substring(word, F.lit(1), i - 1)

    def skipped(i: Column) -> Column:
        edited = F.substring(word, i, F.lit(1))
        opens = (i == 1) | (F.substring(word, i - 1, F.lit(1)) != edited)
        return F.struct(F.concat(behind(i + 1), F.lit(END), before(i)).alias("key"), edited.alias("edited"), opens.alias("opens"))

    def whole(i: Column) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(F.concat(behind(i), F.lit(END), before(i)).alias("key"), none.alias("edited"), F.lit(False).alias("opens"))

    one = F.lit(1)
    gaps = words.filter(size <= TEXT_LETTERS + 1).select(
        F.inline(F.transform(F.sequence(one, size), skipped)), F.when(size <= TEXT_LETTERS, word).otherwise(F.col("id")).alias("id"), "n"
    )
    wholes = words.filter(size <= TEXT_LETTERS).select(
        F.inline(F.transform(F.sequence(one, size + 1), whole)), word.alias("id"), "n"
    )
    return gaps, wholes


def _end_digests(letters: list[bytes]) -> list[bytes]:
    """Digest of the first 0, 1, 2, ... letters."""
    state = hashlib.blake2b(digest_size=16)
    out = [state.digest()]
    for letter in letters:
        state.update(letter)
        out.append(state.copy().digest())
    return out


def long_entries(word: str, least: int = TEXT_LETTERS) -> Iterator[tuple[str, str | None, bool]]:
    """(key, edited, opens) of the skipped forms above `least` letters, and of the whole rotations if the word itself is above.

    A key names place and length of what is skipped and the digests of both parts.
    """
    letters = [c.encode() for c in word]
    size = len(letters)
    front, back = _end_digests(letters), _end_digests(letters[::-1])

    def key(before: int, behind: int) -> str:
        return f"{END}{before}:{before + behind}:{front[before].hex()}{back[behind].hex()}"

    if size - 1 > least:
        for i in range(size):
            yield key(i, size - 1 - i), word[i], i == 0 or word[i - 1] != word[i]
    if size > least:
        for i in range(size + 1):
            yield key(i, size - i), None, False


def _long_entries(words: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("key", pa.string()), ("edited", pa.string()), ("opens", pa.bool_()), ("id", pa.string()), ("n", pa.int64())]
        for batch in batches:
            for row in batch.to_pylist():
                entries = long_entries(row["word"])
                while held := [(*entry, row["id"], row["n"]) for entry in itertools.islice(entries, 8192)]:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(zip(*held), fields)], schema=pa.schema(fields))

    return words.filter(F.length("word") > TEXT_LETTERS).select("word", "id", "n").mapInArrow(cut, ENTRY)


def rotations(words: DataFrame) -> DataFrame:
    """(key, edited, opens, id, n): every rotation of every word of (word, id, n), the edited letter taken off its end.

    `edited` is null for whole rotations; `opens` marks the first of a run of equal letters.
    """
    gaps, wholes = _short_entries(words)
    return gaps.unionByName(wholes).unionByName(_long_entries(words))


def scanned(entries: DataFrame) -> DataFrame:
    """(id, near, other): for each entry with partners in its range, their number and the best one or two, as (n, id).

    The rotations are sorted by ranges of their keys, so a range of partners lies in one task; `near` is null on second rows.
    """
    order = Window.partitionBy("key").orderBy(F.col("edited").isNull(), F.desc("n"), "edited")
    scan = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole, own = F.col("edited").isNull(), F.struct("n", "id")
    held = entries.repartitionByRange("key").withColumns(
        {
            "place": F.row_number().over(order),
            "gaps": F.count_if(~whole).over(scan),
            "opening": F.count_if(F.col("opens")).over(scan),
            "best": F.first(F.when(~whole, own), ignorenulls=True).over(scan),
            "second": F.nth_value(F.when(~whole, own), 2).over(scan),
            "shorter": F.last(F.when(whole, own), ignorenulls=True).over(scan),
            "longer": F.first(F.when(F.col("opens"), own), ignorenulls=True).over(scan),
        }
    )
    replaced = F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("best"))
    dropped = F.when(F.col("opens"), F.col("shorter"))
    near = F.when(whole, F.col("opening")).otherwise(F.col("gaps") - 1 + dropped.isNotNull().cast("int"))
    others = F.when(whole, F.array("longer")).otherwise(F.array(replaced, dropped))
    met = held.withColumn("near", near).filter("near > 0")
    return met.select("id", "near", F.posexplode(F.filter(others, lambda x: x.isNotNull())).alias("nth", "other")).select(
        "id", F.when(F.col("nth") == 0, F.col("near")).alias("near"), "other"
    )


def nearest(words: DataFrame) -> DataFrame:
    """(id, n_near, best): how many near words each word of (word, id, n) has, and the one of largest n as (-n, word).

    Ties go to the smallest word. Words without near words have no row.
    """
    found = scanned(rotations(words))
    long = words.filter(F.length("word") > TEXT_LETTERS).select(F.col("id").alias("other_id"), F.col("word").alias("other_word"))
    named = found.withColumn("other_id", F.col("other.id")).join(long, "other_id", "left")
    other = F.struct((-F.col("other.n")).alias("minus_n"), F.coalesce("other_word", "other_id").alias("word"))
    return named.groupBy("id").agg(F.sum("near").alias("n_near"), F.min(other).alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): the last form that is reached. Each round doubles the steps; n at least doubles with each
    step, so a chain has at most 63 and seven rounds do."""
    pairs = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = pairs.select(F.col("word").alias("root"), F.col("root").alias("further"))
        pairs = pairs.select("word", "root").join(ahead, "root", "left")
        moved = F.col("further").isNotNull().alias("moved")
        pairs = stored(pairs.select("word", F.coalesce("further", "root").alias("root"), moved), "forms")
        if not pairs.filter("moved").count():
            return pairs.drop("moved")


def spelling_groups(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each distinct word of (word, n).

    The form is the near word of largest n, if it occurs at least `times` as often; the root is the last form reached.
    An empty table gives an empty one. Words have two letters at least, and no END.
    """
    long_id = F.concat(F.lit(END), F.sha2("word", 256))
    id_ = F.when(F.length("word") > TEXT_LETTERS, long_id).otherwise(F.col("word"))
    words = stored(words.select("word", id_.alias("id"), "n"), "words")
    chosen = F.col("best").isNotNull() & (-F.col("best.minus_n") >= times * F.col("n"))
    judged = words.join(nearest(words), "id", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("best.word")).alias("form"),
        F.when(chosen, -F.col("best.minus_n")).alias("form_n"),
    )
    judged = stored(judged, "judged")
    roots = last_forms(judged.filter("form IS NOT NULL").select("word", "form"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Spelling groups of the words of `documents` (doc_id, text; other columns are ignored). Null and empty texts have no
    words; repeated rows and ids count as often as they occur."""
    return spelling_groups(corpus_words(docs)).select("word", "n", "n_near", "form", "form_n", "root")
