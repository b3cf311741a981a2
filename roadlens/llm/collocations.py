"""Phrase collocations by partitioning (SON): complete mining of shards, then one exact global count.

Texts (A-Z lowered) are split at ``.,;:!?`` and line ends into pieces, and those at spaces and tabs
into words; a phrase is up to ``LONGEST`` consecutive words of one piece. Everything is per
language. A phrase with ``support`` occurrences in all must have at least ``support / SHARDS``
in one of ``SHARDS`` shards, however the texts are dealt. So every shard is mined completely at the
support lowered in that proportion; the union of what is frequent in some shard holds every
frequent phrase, and with it all of its parts. Another pass counts all candidates over all texts.

There are ``SHARDS`` shards whatever the size of the input, so the lowered support stays well above
one: a shard is a set of read tasks, and Spark mines it level by level. Tasks add up the words
they see, and one group-by (combined on the map side) sums them per shard; candidates are
counted. Pairs of frequent words follow in the same way, and then longer phrases where each
pair of words in them is frequent. Tasks know the candidates by a bit table of at most ``TABLE`` bits (16 MB), which
lets a few others through; these cost time and are dropped by a join on the keys. If the table
fills up, more get through; results do not depend on it. Phrases travel as keys; only those with
``support`` occurrences are put into words, in a pass at the end, from texts whose hash falls into
the lowest of ``SPOTS`` parts in which the phrase occurs.

Of the phrases with ``support`` occurrences, each cut after its first k words gives
``floor(1000 * a * n / (l * r))`` from the counts of the phrase and its two parts and the number of
words; the lowest cut is the score. Phrases inside a longer one with the same count are dropped.
Keys of phrases are 64-bit hashes.

Edge cases: null text is empty, a null language is ``und``; texts without words add none; a
language without frequent phrases gives no rows; repeated rows count each; an empty table gives no rows.
Texts are never cut, so a task holds one text's words at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import settle, sized, text_blocks
from roadlens.llm.words import U, find_words, lower_ascii, mix, word_hashes

LONGEST = 5
SUPPORT = 100
TOP = 2000
SHARDS = 8
TABLE = 1 << 27  # most bits of a table of candidates
SPOTS = 256
FLUSH = 1 << 21  # occurrences gathered in a task before they are added up

BREAK = np.zeros(256, bool)  # bytes that end a piece: . , ; : ! ? and \x0A-\x0D
BREAK[[ord(c) for c in ".,;:!?"]] = True
BREAK[0x0A:0x0E] = True
INSIDE = ~BREAK  # bytes of words
INSIDE[[0x20, 0x09]] = False


class _Words:
    """The words of a block of texts: their bytes, hashes, languages, and which of them go on in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, tongues: np.ndarray, spots: np.ndarray):
        data = lower_ascii(data)
        s, e, bounds = find_words(data, offsets, INSIDE)
        breaks = np.zeros(len(data) + 1, np.int32)
        np.cumsum(BREAK[data], out=breaks[1:])
        text = np.searchsorted(bounds, np.arange(len(s)), "right") - 1
        self.data, self.start, self.end = data, s.astype(np.int32), e.astype(np.int32)
        self.hash = word_hashes(data, s, e)
        self.tongue, self.spot = tongues[text], spots[text]
        self.goes_on = np.zeros(len(s), bool)
        if len(s):
            self.goes_on[:-1] = (breaks[s[1:]] == breaks[s[:-1]]) & (text[1:] == text[:-1])


def _longer(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Keys of phrases from those of the phrases without their last word, and that word's hash."""
    return mix(keys * U(0x9E3779B97F4A7C15) + hashes)


def _walk(words: _Words, langs: np.ndarray, longest: int, frequent) -> None:
    """Show ``frequent(length, places, keys)`` the phrases of each length that can be frequent; it says which of them are."""
    at = np.arange(len(words.hash))
    keys = _longer(langs[words.tongue], words.hash)
    for k in range(1, longest + 1):
        ok = frequent(k, at, keys)
        if k == longest or not ok.any():
            return
        at, keys = at[ok], keys[ok]
        # one word longer: the phrase goes on in its piece, and the phrase at the next place is frequent too
        on = np.zeros(len(at), bool)
        on[:-1] = (at[1:] == at[:-1] + 1) & words.goes_on[at[:-1] + k - 1]
        at, keys = at[on], keys[on]
        keys = _longer(keys, words.hash[at + k])


def _blocks(batches: Iterator[pa.RecordBatch], langs: dict[str, tuple[int, int]]) -> Iterator[_Words]:
    """The words of blocks of texts; ``langs`` gets the languages so far, ``{name: (code, hash)}``."""
    for batch in batches:
        names = batch.column(1).to_pylist()
        for name, code in zip(names, batch.column(2).to_pylist()):
            langs.setdefault(name, (len(langs), code))
        codes = np.array([langs[n][0] for n in names], np.int32)
        spots = batch.column(3).to_numpy().astype(np.uint8)
        for a, b, data, offsets in text_blocks(batch.column(0)):
            yield _Words(data, offsets, codes[a:b], spots[a:b])


def _hashes(langs: dict) -> np.ndarray:
    return np.array([h for _, h in langs.values()], np.int64).view(U)


def _in_table(table: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    if table is None:
        return np.ones(len(keys), bool)
    place = keys & U(8 * len(table) - 1)
    return (table[place >> U(3)] >> (place & U(7)).astype(np.uint8)) & 1 == 1


def _at_spot(keys: np.ndarray, spots: np.ndarray) -> np.ndarray:
    return keys ^ (spots.astype(U) << U(7))


def _miner(shards: int, shortest: int, longest: int, table, listed: bool = False):
    """``shard, key, n, spot``: a task's occurrences of the phrases of ``shortest`` to ``longest`` words; a shard is a set of tasks.

    Shorter phrases only lead to longer ones if the table has them; with ``listed`` no phrase counts that it does not have.
    """

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        bits = table.value if table is not None else None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        langs: dict[str, tuple[int, int]] = {}

        def added() -> pa.RecordBatch:
            keys, spots = (np.concatenate(part) for part in zip(*held))
            held.clear()
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
            n = np.diff(np.append(first, len(keys)))
            spot = np.minimum.reduceat(spots[order], first) if len(first) else spots
            columns = [pa.array(np.full(len(first), shard, np.int32)), pa.array(keys[first].view(np.int64)), pa.array(n), pa.array(spot.astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "key", "n", "spot"])

        for words in _blocks(batches, langs):

            def see(k: int, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
                ok = _in_table(bits if listed or k < shortest else None, keys)
                if k >= shortest:
                    held.append((keys[ok], words.spot[at[ok]]))
                return ok

            _walk(words, _hashes(langs), longest, see)
            if sum(len(h[0]) for h in held) >= FLUSH:
                yield added()
        if held:
            yield added()

    return mine


def _namer(longest: int, table, spotted):
    """``key, lang, phrase, n``: each phrase of the table in words, once per task at its spot; and a language's words, with a null key."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, spots, said = table.value, spotted.value, np.zeros(0, U)
        langs: dict[str, tuple[int, int]] = {}
        total: dict[str, int] = {}

        def rows(key, lang, phrase, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([key, lang, phrase, pa.array(n, pa.int64())], names=["key", "lang", "phrase", "n"])

        for words in _blocks(batches, langs):
            found, names = [], list(langs)

            def see(k: int, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
                ok = _in_table(bits, keys)
                here = ok & _in_table(spots, _at_spot(keys, words.spot[at]))
                found.append((k, at[here], keys[here]))
                return ok

            _walk(words, _hashes(langs), longest, see)
            for code, n in enumerate(np.bincount(words.tongue, minlength=len(names)).tolist()):
                total[names[code]] = total.get(names[code], 0) + n
            raw = memoryview(words.data)
            for k, at, keys in found:
                kinds, first = np.unique(keys, return_index=True)
                place = np.searchsorted(said, kinds)
                new = said[np.minimum(place, len(said) - 1)] != kinds if len(said) else np.ones(len(kinds), bool)
                part = at[first[new]]
                pieces = [[raw[a:b] for a, b in zip(words.start[part + j].tolist(), words.end[part + j].tolist())] for j in range(k)]
                phrases = pa.array([b" ".join(p) for p in zip(*pieces)], pa.binary()).cast(pa.string())
                lang = pa.array(names, pa.string()).take(pa.array(words.tongue[part]))
                yield rows(pa.array(kinds[new].view(np.int64)), lang, phrases, pa.nulls(len(part), pa.int64()))
                said = np.insert(said, place[new], kinds[new])
        some = [name for name, n in total.items() if n]
        yield rows(pa.nulls(len(some), pa.int64()), pa.array(some, pa.string()), pa.nulls(len(some), pa.string()), [total[s] for s in some])

    return name


def _table(keys: DataFrame, most: int):
    """A broadcast bit table of settled ``keys``: bit ``key mod size``, 16 bits a key as long as ``most`` allows."""
    spark = keys.sparkSession
    bits = 64
    n = keys.count()
    while bits < min(most, 16 * n):
        bits *= 2
    word = keys.selectExpr(f"pmod(key, {bits}L) AS _p").groupBy(F.expr("CAST(_p div 64 AS INT) AS w"))
    word = word.agg(F.expr("bit_or(shiftleft(1L, CAST(_p % 64 AS INT))) AS b")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[word["w"].to_numpy()] = word["b"].to_numpy()
    return spark.sparkContext.broadcast(out.astype("<i8").view(np.uint8))


def frequent_phrases(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS, table: int = TABLE
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, a`` of all phrases of 1 to ``longest`` words with ``support`` occurrences, and ``lang, n``."""
    texts = docs.selectExpr("coalesce(text, '') AS text", "coalesce(lang, 'und') AS lang")
    texts = texts.selectExpr("text", "lang", "xxhash64(lang) AS _hash", f"CAST(pmod(xxhash64(text), {SPOTS}) AS INT) AS _spot")
    lowered = -(-support // shards)
    counted = lambda *how: texts.mapInArrow(_miner(*how), "shard int, key long, n long, spot int")
    own, known = None, None
    for shortest, most in ((1, 1), (2, 2), (3, longest)):  # words, pairs, and all longer ones
        if most > longest or shortest > longest:
            break
        seen = counted(shards, shortest, most, known).groupBy("shard", "key").agg(F.sum("n").alias("n"))
        found = settle(seen.where(F.col("n") >= lowered).select("key").distinct())
        known = _table(found if own is None else settle(own.select("key").unionByName(found)), table)
        counts = counted(1, shortest, most, known, True).groupBy("key").agg(F.sum("n").alias("a"), F.min("spot").alias("spot"))
        counts = counts.where(F.col("a") >= support).join(found, "key", "left_semi")
        own = settle(counts if own is None else own.unionByName(counts))
        known = _table(own, table)
    spotted = _table(own.selectExpr("key ^ shiftleft(CAST(spot AS BIGINT), 7) AS key"), table)
    named = texts.mapInArrow(_namer(longest, known, spotted), "key long, lang string, phrase string, n long")
    named = settle(named.groupBy("key", "lang", "phrase").agg(F.sum("n").alias("n")))
    phrases = own.join(named.where("key IS NOT NULL"), "key")
    phrases = settle(phrases.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("size"), "a"))
    return phrases, named.where("key IS NULL").select("lang", "n")


def collocations(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, percent: int = 100, shards: int = SHARDS, table: int = TABLE
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best ``top`` phrases of 2 to ``longest`` words."""
    phrases, totals = frequent_phrases(docs, support, longest, shards, table)
    listed = sized(phrases.select("lang", "phrase", "a"))
    # parts one word shorter, with the highest count of what they lie in
    short = "inline(array(struct(slice(w, 1, size - 1) AS p), struct(slice(w, 2, size - 1) AS p)))"
    within = phrases.where("size > 2").selectExpr("lang", "a", "size", "split(phrase, ' ') AS w").selectExpr("lang", "a", short)
    within = within.groupBy("lang", F.array_join("p", " ").alias("phrase")).agg(F.max("a").alias("_longer"))
    own = phrases.where("size > 1").join(within, ["lang", "phrase"], "left").where(f"_longer IS NULL OR 100 * _longer < {percent} * a")
    cuts = own.selectExpr("lang", "phrase", "a", "size", "split(phrase, ' ') AS w", "explode(sequence(1, size - 1)) AS k")
    cuts = cuts.selectExpr("lang", "phrase", "a", "k", "array_join(slice(w, 1, k), ' ') AS _l", "array_join(slice(w, k + 1, size - k), ' ') AS _r")
    left = listed.select("lang", F.col("phrase").alias("_l"), F.col("a").alias("l"))
    right = listed.select("lang", F.col("phrase").alias("_r"), F.col("a").alias("r"))
    scored = cuts.join(left, ["lang", "_l"]).join(right, ["lang", "_r"]).join(sized(totals), "lang")
    big = lambda c: f"CAST({c} AS DECIMAL(17, 0))"
    score = f"CAST((CAST(1000 AS DECIMAL(4, 0)) * {big('a')} * {big('n')}) div ({big('l')} * {big('r')}) AS BIGINT)"
    scored = scored.selectExpr("lang", "phrase", "a", "n", f"struct({score} AS score, k, l, r) AS cut")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut")).selectExpr("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    # the best of slices of a language first, so that no task sorts a whole language
    order = "ORDER BY score DESC, a DESC, phrase"
    best = best.selectExpr("*", f"row_number() OVER (PARTITION BY lang, pmod(xxhash64(phrase), 256) {order}) AS _slice").where(F.col("_slice") <= top)
    ranked = best.selectExpr("*", f"CAST(row_number() OVER (PARTITION BY lang {order}) AS BIGINT) AS rank").where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(docs: DataFrame) -> DataFrame:
    return collocations(docs)


SQL = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 6) t(k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
x AS (SELECT *, string_split(phrase, ' ') AS w FROM f),
inside AS (SELECT lang, phrase, max(a) AS longer FROM (
  SELECT lang, a, array_to_string(w[1:k - 1], ' ') AS phrase FROM x WHERE k > 2 UNION ALL
  SELECT lang, a, array_to_string(w[2:k], ' ') FROM x WHERE k > 2) GROUP BY ALL),
own AS (SELECT x.* FROM x LEFT JOIN inside USING (lang, phrase) WHERE k > 1 AND (longer IS NULL OR longer < a)),
cuts AS (SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS lp, array_to_string(w[c + 1:k], ' ') AS rp FROM own, range(1, 5) t(c) WHERE c < k),
scored AS (SELECT cuts.*, l.a AS l, r.a AS r, n, ((1000::HUGEINT * cuts.a * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = lp JOIN f r ON r.lang = cuts.lang AND r.phrase = rp JOIN n ON n.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best QUALIFY rank <= 2000"""
