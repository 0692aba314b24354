"""Phrase collocations by best-first branch and bound over word prefixes.

Everything is counted per language. Words stand for themselves as 64-bit hashes that are checked to be distinct, so all
counts are exact. A phrase is cut into a first part and a rest; its score is the least ``a² / (l r)`` of its cuts, in
millionths. Growing a prefix of count ``a`` by a word can only lose occurrences, and the rest after the first word occurs at
least as often as the whole, so no phrase that a prefix grows into scores above ``a / f(first word)``.

The frontier is all frequent two-word phrases, each a finished candidate and a prefix to grow. Every round takes a floor for the scores
of each language, grows the prefixes whose bound reaches it, and on the other side the phrases whose score
does, so that all longer candidates that could outlive or absorb them are known. Once enough phrases at or above the floor
survive, no phrase below it can be among the best. Otherwise the floor is lowered and the frontier grown on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.llm.graph import saved
from lakewright.llm.texts import BATCH_CHARS, map_batches, release, utf8_of
from lakewright.operators.keyed_joins import keyed_join, matching_keys

TOP = 2000
LEAST_COUNT = 10
ABSORBED_PERCENT = 50  # of a phrase's occurrences: one longer candidate with so many takes its place
FIRST_TAKEN = 4000  # two-word phrases of each language at or above the first floor; decides how many rounds there are
GROWTH = 4  # of that number from round to round
PORTION = 4 * BATCH_CHARS
BUCKETS = 1 << 22  # of the filters; they let pass all that counts, and little else
MAX_WORDS = 1 << 19  # words that a worker keeps the hashes of
LISTED_LANGUAGES = 10_000  # up to so many open languages, later rounds read the texts of those only
RANK_PARTS = 64
BROADCAST_BYTES = 4 << 20  # of words or phrases; the driver holds a table that is broadcast several times over, so larger ones are shuffled
SCORE_STEP = 1000  # floors are multiples of it

# Fixed: what parts pieces, and what parts words besides a blank.
_TABLE = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
_NOTHING, _BREAK = 0, 1


class _Hashes(dict):
    """Numbers of words, the hash of each; the empty word and the break between pieces come first."""

    def __init__(self, seed: int):
        from xxhash import xxh3_64_intdigest

        self.digest, self.seed = xxh3_64_intdigest, seed
        self.hashes: list[int] = []
        self[b""], self[b"\n"]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.hashes.append(self.digest(word, self.seed))
        return number


class Reader:
    """Turns texts into word numbers; made anew for each task."""

    def __init__(self, seed: int):
        self.seed = seed
        self.known = _Hashes(seed)

    def numbers(self, texts: list[bytes]) -> np.ndarray:
        """The words of all texts, as numbers, with a break between pieces and texts."""
        if len(self.known) > MAX_WORDS:
            self.known = _Hashes(self.seed)
        words = b"\n".join(texts).lower().translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return found[found != _NOTHING]

    def hashes(self) -> np.ndarray:
        """The hash of every number."""
        return np.array(self.known.hashes, np.uint64)


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    groups: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), utf8_of(batch.column("text")), strict=True):
        groups.setdefault(lang, []).append(text)
    yield from groups.items()


def _count_words(seed: int) -> Callable[[pa.RecordBatch], dict[str, object]]:
    reader = []

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        reader[:] = reader or [Reader(seed)]
        langs, hashes, words, counts = [], [np.empty(0, np.uint64)], [], [np.empty(0, np.int64)]
        for lang, texts in _by_language(batch):
            times = np.bincount(reader[0].numbers(texts), minlength=2)
            times[_BREAK] = 0
            own = np.flatnonzero(times)
            names = list(reader[0].known)
            langs += [lang] * len(own)
            words += [names[n].decode() for n in own]
            hashes.append(reader[0].hashes()[own])
            counts.append(times[own])
        return {"lang": langs, "h": np.concatenate(hashes).view(np.int64), "word": words, "n": np.concatenate(counts)}

    return convert


def pair_bucket(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return ((first ^ (second >> np.uint64(7))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _pair_bucket_column(first: str, second: str) -> Column:
    return F.expr(f"cast(({first} ^ shiftrightunsigned({second}, 7)) & {BUCKETS - 1} as int)")


def _word_bucket_column(word: str) -> Column:
    return F.expr(f"cast({word} & {BUCKETS - 1} as int)")


def _filter(rows: DataFrame, bucket: Column) -> np.ndarray:
    """Packed bits of the buckets that occur; at most BUCKETS small numbers reach the driver."""
    seen = np.zeros(BUCKETS, bool)
    seen[rows.select(bucket.alias("bucket")).distinct().toArrow()["bucket"].to_numpy()] = True
    release()
    return np.packbits(seen)


def _unpacked(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits).view(bool)


def _phrases(batch: pa.RecordBatch, reader: Reader, words: int, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> dict[str, object]:
    """Counts of the runs of ``words`` words; ``keep`` gets the hash of every word in the text and says at which places runs count."""
    langs: list[str] = []
    columns = [[np.empty(0, np.uint64)] for _ in range(words)]
    counts = [np.empty(0, np.int64)]
    for lang, texts in _by_language(batch):
        numbers = reader.numbers(texts)
        hashes = reader.hashes()
        places = np.flatnonzero(keep(numbers, hashes[numbers]))
        # A run's first words, as the number of their combination, and its next word make a new combination.
        key = numbers[places]
        for k in range(1, words):
            if k > 1:
                key = np.unique(key, return_inverse=True)[1]
            key = key * len(hashes) + numbers[places + k]
        _, at, times = np.unique(key, return_index=True, return_counts=True)
        langs += [lang] * len(at)
        for k, column in enumerate(columns):
            column.append(hashes[numbers[places[at] + k]])
        counts.append(times)
    out = {f"h{k + 1}": np.concatenate(column).view(np.int64) for k, column in enumerate(columns)}
    return {"lang": langs, **out, "n": np.concatenate(counts)}


def _runs(numbers: np.ndarray, good: np.ndarray, words: int) -> np.ndarray:
    """Where a run of ``words`` good words begins that no break parts."""
    good = good & (numbers != _BREAK)
    out = np.zeros(len(numbers), bool)
    if len(numbers) >= words:
        out[: len(numbers) - words + 1] = np.logical_and.reduce([good[k : len(good) - words + 1 + k] for k in range(words)])
    return out


def _count_pairs(seed: int, frequent: np.ndarray) -> Callable[[pa.RecordBatch], dict[str, object]]:
    reader: list[Reader] = []
    known: list[np.ndarray] = []

    def keep(numbers: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        return _runs(numbers, known[0][(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)], 2)

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        reader[:] = reader or [Reader(seed)]
        known[:] = known or [_unpacked(frequent)]
        return _phrases(batch, reader[0], 2, keep)

    return convert


def _count_triples(seed: int, pairs: np.ndarray, prefixes: np.ndarray, suffixes: np.ndarray) -> Callable[[pa.RecordBatch], dict[str, object]]:
    reader: list[Reader] = []
    known: list[np.ndarray] = []

    def keep(numbers: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        out = _runs(numbers, np.ones(len(numbers), bool), 3)
        if len(numbers) > 2:
            pairs, prefixes, suffixes = known
            first, second = pair_bucket(hashes[:-2], hashes[1:-1]), pair_bucket(hashes[1:-1], hashes[2:])
            out[:-2] &= pairs[first] & pairs[second] & (prefixes[first] | suffixes[second])
        return out

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        reader[:] = reader or [Reader(seed)]
        known[:] = known or [_unpacked(bits) for bits in (pairs, prefixes, suffixes)]
        return _phrases(batch, reader[0], 3, keep)

    return convert


def count_words(docs: DataFrame) -> tuple[DataFrame, int]:
    """(lang, h, word, n) of every word of ``docs`` (lang, text), and the seed under which the hashes ``h`` are distinct."""
    for seed in range(8):
        parts = map_batches(docs, "lang string, h bigint, word string, n bigint", _count_words(seed), size=PORTION)
        grouped = parts.groupBy("lang", "h").agg(F.sum("n").alias("n"), F.min("word").alias("word"), F.max("word").alias("other"))
        words = saved(grouped, "words")
        if words.where(F.col("word") != F.col("other")).isEmpty():
            return words.drop("other"), seed
    raise RuntimeError("no seed gives all words hashes of their own")


def score_of(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1000000 a² / (l r)), in whole numbers of up to 38 digits: counts of up to 13 digits."""
    wide = [f"cast({name} as decimal(13, 0))" for name in (a, l, r)]
    return F.expr(f"cast(cast(1000000 as decimal(7, 0)) * {wide[0]} * {wide[0]} div ({wide[1]} * {wide[2]}) as bigint)")


def _floors(frontier: DataFrame, taken: int) -> DataFrame:
    """(lang, floor): the highest step that ``taken`` two-word phrases of the language reach, 0 where there are fewer."""
    steps = frontier.groupBy("lang", (F.expr(f"score div {SCORE_STEP}")).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("step")))
    reached = F.max(F.when(F.col("above") >= taken, F.col("step")))
    return steps.withColumn("above", above).groupBy("lang").agg((F.coalesce(reached, F.lit(0)) * SCORE_STEP).alias("floor"))


def collocations(
    docs: DataFrame, top: int = TOP, least_count: int = LEAST_COUNT, absorbed_percent: int = ABSORBED_PERCENT, first_taken: int = FIRST_TAKEN
) -> DataFrame:
    """The best ``top`` phrases of two and three words of each language of ``docs`` (text, lang).

    Columns lang, rank, phrase, a, l, r, n, score: occurrences of the phrase, of both parts of its lowest-scoring cut, and of
    all words of the language. Texts are A-Z lower-cased and cut into pieces at ``.,;:!?`` and line ends; words are parted by blanks
    and tabs. Phrases that occur less than ``least_count`` times (2 at least) are none. A phrase inside a longer candidate that has at least
    ``absorbed_percent`` of its occurrences goes. Order: score and count descending, phrase ascending in bytes.

    A null text is empty, a null language is ``und``; languages without phrases have no rows. Repeated rows count each time,
    rows without an id like any other; other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words, seed = count_words(texts)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least_count)
    word_filter = _filter(frequent, _word_bucket_column("h"))

    counted = map_batches(texts, "lang string, h1 bigint, h2 bigint, n bigint", _count_pairs(seed, word_filter), size=PORTION)
    pairs = counted.groupBy("lang", "h1", "h2").agg(F.sum("n").alias("a")).where(F.col("a") >= least_count)
    pairs = saved(pairs, "pairs")
    first = frequent.select("lang", F.col("h").alias("h1"), F.col("n").alias("l"))
    last = frequent.select("lang", F.col("h").alias("h2"), F.col("n").alias("r"))
    scored = _looked_up(pairs, [(first, ["h1"]), (last, ["h2"])])
    scored = scored.withColumns({"score": score_of("a", "l", "r"), "bound": F.expr("cast(1000000 as decimal(7, 0)) * a div l")})
    frontier = saved(scored.select("lang", "h1", "h2", "a", "l", "r", "score", F.col("bound").cast("bigint").alias("bound")), "frontier")
    pair_filter = _filter(frontier, _pair_bucket_column("h1", "h2"))

    triples, done, taken = None, None, first_taken
    floors = saved(_floors(frontier, taken), "floors").withColumn("before", F.lit(None).cast("bigint"))
    while not floors.isEmpty():
        active = keyed_join(frontier, floors, ["lang"], "inner", right_bytes=0)
        fresh = F.col("before").isNull()
        grown = active.where((F.col("bound") >= F.col("floor")) & (fresh | (F.col("bound") < F.col("before"))))
        ahead = active.where((F.col("score") >= F.col("floor")) & (fresh | (F.col("score") < F.col("before"))))
        prefixes, suffixes = (_filter(rows, _pair_bucket_column("h1", "h2")) for rows in (grown, ahead))
        counted = map_batches(
            _open_texts(texts, floors),
            "lang string, h1 bigint, h2 bigint, h3 bigint, n bigint",
            _count_triples(seed, pair_filter, prefixes, suffixes),
            size=PORTION,
        )
        counted = counted.groupBy("lang", "h1", "h2", "h3").agg(F.sum("n").alias("a")).where(F.col("a") >= least_count)
        counted = saved(counted, "counted")
        counted = saved(_scored_triples(counted, pairs, frequent), "triples")
        # Rounds may meet the same phrase, with the same count.
        triples = counted if triples is None else triples.unionByName(counted).distinct()
        alive = saved(_survivors(active, keyed_join(triples, floors, ["lang"], "inner", right_bytes=0), absorbed_percent), "survivors")
        enough = alive.groupBy("lang").agg(F.count(F.lit(1)).alias("alive"))
        settled = (F.coalesce("alive", F.lit(0)) >= top) | (F.col("floor") == 0)
        state = saved(floors.join(enough, "lang", "left").withColumn("settled", settled), "state")
        finished = alive.join(state.where("settled").select("lang"), "lang", "left_semi")
        done = finished if done is None else done.unionByName(finished)
        taken *= GROWTH
        following = _floors(frontier, taken).join(state.where(~F.col("settled")).select("lang", F.col("floor").alias("before")), "lang")
        floors = saved(following, "floors")
    if done is None:
        return spark.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    return _ranked(_spelt(done, frequent), totals, top)


def _open_texts(texts: DataFrame, floors: DataFrame) -> DataFrame:
    """The texts of languages that are not settled; all texts where those are too many to list."""
    listed = [row["lang"] for row in floors.select("lang").limit(LISTED_LANGUAGES + 1).collect()]
    return texts if len(listed) > LISTED_LANGUAGES else texts.where(F.col("lang").isin(listed))


def _looked_up(rows: DataFrame, tables: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Saved ``rows`` joined to each of the tables on the language and its columns; written out in between, as a shuffled join first counts its rows."""
    for number, (right, on) in enumerate(tables):
        rows = keyed_join(saved(rows, "looked_up") if number else rows, right, ["lang", *on], "inner", BROADCAST_BYTES)
    return rows


def _scored_triples(counted: DataFrame, pairs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Three-word phrases with the lower-scoring of their two cuts."""
    first = frequent.select("lang", F.col("h").alias("h1"), F.col("n").alias("l1"))
    last = frequent.select("lang", F.col("h").alias("h3"), F.col("n").alias("r2"))
    front = pairs.select("lang", "h1", "h2", F.col("a").alias("l2"))
    back = pairs.select("lang", F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("r1"))
    rows = _looked_up(counted, [(first, ["h1"]), (last, ["h3"]), (front, ["h1", "h2"]), (back, ["h2", "h3"])])
    rows = rows.withColumns({"s1": score_of("a", "l1", "r1"), "s2": score_of("a", "l2", "r2")})
    early = F.col("s1") <= F.col("s2")
    chosen = {name: F.when(early, F.col(f"{name}1")).otherwise(F.col(f"{name}2")).alias(name) for name in ("l", "r")}
    return rows.select("lang", "h1", "h2", "h3", "a", chosen["l"], chosen["r"], F.least("s1", "s2").alias("score"))


def _survivors(active: DataFrame, triples: DataFrame, absorbed_percent: int) -> DataFrame:
    """Phrases at or above the floor of their language that no longer candidate absorbs."""
    columns = ["lang", "h1", "h2", "h3", "a", "l", "r", "score"]
    reached = F.col("score") >= F.col("floor")
    inside = triples.select("lang", "h1", "h2", "a").unionByName(
        triples.select("lang", F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a")
    )
    longest = inside.groupBy("lang", "h1", "h2").agg(F.max("a").alias("longer"))
    two = active.where(reached).join(longest, ["lang", "h1", "h2"], "left")
    whole = (lambda name: F.col(name).cast("decimal(20, 0)"))
    absorbed = 100 * whole("longer") >= absorbed_percent * whole("a")
    two = two.where(~F.coalesce(absorbed, F.lit(False))).withColumn("h3", F.lit(None).cast("bigint"))
    return two.select(*columns).unionByName(triples.where(reached).select(*columns))


def _spelt(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """``phrase`` in place of the hashes."""
    used = rows.select("lang", F.explode(F.array("h1", "h2", "h3")).alias("h")).distinct()
    words = saved(matching_keys(frequent.select("lang", "h", "word"), used, ["lang", "h"], True, BROADCAST_BYTES), "names")
    for k in (1, 2, 3):
        names = words.select("lang", F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}"))
        rows = keyed_join(rows, names, ["lang", f"h{k}"], "left", BROADCAST_BYTES)
    return rows.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))


def _ranked(rows: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The best ``top`` of each language: of each part of its phrases first, then of what is left of all parts."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    for part in (Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))), Window.partitionBy("lang")):
        rows = rows.withColumn("rank", F.row_number().over(part.orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    named = rows.join(totals, "lang")
    return named.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
