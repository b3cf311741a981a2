"""Near-duplicate documents by min-max hashing, confirmed on the full shingle sets.

A document is its set of distinct ``k``-word shingles (A-Z lowered; a shorter text is one
shingle). Documents with equal sets form one class, so copies never meet in pairs. For a class,
every hash function gives two signature values, the minimum and the maximum of the hashed set:
each agrees between two sets with probability equal to their similarity, for one evaluation.
``ROWS`` values make a band, ``BANDS`` bands a signature, half of them minima and half the same
functions' maxima; classes with an equal band are candidates. At similarity 0.8 a pair shares no
band with probability (1 - 0.8**6)**45, about 1e-6; pairs in larger groups have further ways to
be found.

Only components are asked for, so a bucket (equal band) does not emit its pairs: each bucket has
one member as its centre, each member is tested against the nearest (by sketch) centre of another
component, and confirmed links are contracted. Such rounds, each with other centres, go on while
at least one in ``PAYS`` tested pairs is a link, so what is left in pieces of a group meets ever
new members of the group. Then the pairs of each bucket that still
lie in different components, and only those, are candidates, so that no link found by a band
is lost. A candidate pair must also
be near in its sketches (the last two bits of 1024 signature values: at the asked similarity
a pair falls short of the limit with a probability of about 1e-5), it is emitted by the first of
its buckets only, and every link is confirmed on the full sets of both texts (exact counts of
64-bit shingle hashes). The pairs left after the rounds must also pass a bound that no link fails:
shingles fall on 1024 bits, a set keeps the parity of each, and two sets differ in at least as many
shingles as parities. In a large group whose members are just not similar enough this leaves few.

Edge cases: null, empty and white texts have no shingles, are linked with nothing and are their
own component; a component is named by its smallest non-null doc_id (null if it has none);
repeated rows are equal sets; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from roadlens.llm.common import few, settle, sized, text_blocks, trimmed
from roadlens.llm.components import components
from roadlens.llm.words import U, find_words, lower_ascii, mix, windows, word_hashes

SHINGLE = 5
PERCENT = 80
ROWS = 6
BANDS = 45
PAYS = 10
SETS = 8 << 20  # bytes of full sets that are broadcast
BLOCK = 1 << 17  # bytes of text in work at a time
TEXTS = 1024  # texts signed at a time
SKETCH = 16  # words of 64 signature values; two bits of each are kept, in two words
PARITY = 16  # words of 64 parities
SIGMAS = 4.25
SLICE = 1 << 16  # shingles hashed at a time


def shingle_sets(col: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, hashes, bounds)`` per block: each text's distinct shingle hashes, sorted."""
    for first, end, data, offsets in text_blocks(col, BLOCK):
        data = lower_ascii(data)
        s, e, bounds = find_words(data, offsets)
        hashes = word_hashes(data, s, e)
        found, at = windows(hashes, bounds, k)
        text = np.searchsorted(bounds, at, "right") - 1
        # a shorter text is one shingle: the hash of its words in order
        size = np.diff(bounds)
        for n in range(1, k):
            short = np.flatnonzero(size == n)
            if len(short):
                one = np.full(len(short), U(n))
                for j in range(n):
                    one = mix(one * U(0x9E3779B97F4A7C15) + hashes[bounds[short] + j])
                found, text = np.concatenate([found, one]), np.concatenate([text, short])
        order = np.lexsort((found, text))
        found, text = found[order], text[order]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
        found, text = found[new], text[new]
        yield first, end, found, np.searchsorted(text, np.arange(end - first + 1))


def _identity(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set: a mixed sum over its shingles and their number."""
    sums = np.zeros(len(found) + 1, U)
    np.cumsum(mix(found ^ U(0x5851F42D4C957F2D)), out=sums[1:])
    return mix((sums[bounds[1:]] - sums[bounds[:-1]]) + mix(np.diff(bounds).astype(U)))


def _signatures(found: np.ndarray, bounds: np.ndarray, rows: int, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (texts x bands) and two-bit sketches of min-max signatures; all texts must have shingles."""
    n = len(bounds) - 1
    evaluations = (max(rows * bands, 64 * SKETCH) + 1) // 2
    seeds = mix(np.arange(1, evaluations + 1, dtype=U) * U(0xD1342543DE82EF95))
    signature = np.empty((2 * evaluations, n), U)
    at, first = bounds[:-1], (rows * bands + 1) // 2
    # banded are the minima of the first functions, in order, then the same functions' maxima; others follow
    for i, seed in enumerate(seeds):
        hashed = (found ^ seed) * (seed | U(1))
        hashed ^= hashed >> U(32)
        low, high = (i, first + i) if i < first else (first + i, evaluations + i)
        np.minimum.reduceat(hashed, at, out=signature[low])
        np.maximum.reduceat(hashed, at, out=signature[high])
    out = np.empty((n, bands), U)
    for b in range(bands):
        h = np.full(n, U(b + 1))
        for r in range(rows):
            h = mix(h * U(0x9E3779B97F4A7C15) + signature[b * rows + r])
        out[:, b] = h
    sketch = np.zeros((n, 2 * SKETCH), U)
    for i in range(64 * SKETCH):
        sketch[:, i // 64] |= (signature[i] & U(1)) << U(i % 64)
        sketch[:, SKETCH + i // 64] |= ((signature[i] >> U(1)) & U(1)) << U(i % 64)
    return out, sketch


def _parities(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per set, for each of ``64 * PARITY`` bits, whether an odd number of its shingles falls on it."""
    n, bits = len(bounds) - 1, 64 * PARITY
    at = (mix(found ^ U(0x2545F4914F6CDD1D)) % U(bits)).astype(np.int64)
    at += np.repeat(np.arange(n) * bits, np.diff(bounds))
    odd = (np.bincount(at, minlength=n * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, bits), axis=1, bitorder="little").view("<u8")


def _signer(k: int, rows: int, bands: int):
    """From ``doc_id, text`` and further columns to the latter's place ``n_shingles, node, bands, sketch, parity``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, found, bounds in shingle_sets(batch.column(1), k):
                sizes = np.diff(bounds)
                names = _identity(found, bounds)
                full = np.flatnonzero(sizes)
                keys = np.zeros((b - a, bands), U)
                sketch = np.zeros((b - a, 2 * SKETCH), U)
                parity = np.zeros((b - a, PARITY), U)
                # texts in slices of bounded work arrays; empty ones lie between without shingles
                for part in np.array_split(full, max(1, len(found) // SLICE, -(-len(full) // TEXTS))) if len(full) else ():
                    if len(part):
                        low, high = bounds[part[0]], bounds[part[-1] + 1]
                        cut = np.append(bounds[part], high) - low
                        keys[part], sketch[part] = _signatures(found[low:high], cut, rows, bands)
                        parity[part] = _parities(found[low:high], cut)
                some = sizes > 0
                flat = pa.array(keys[some].reshape(-1).view(np.int64))
                counts = np.append(0, np.cumsum(some * bands)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(names.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(counts), flat),
                        pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * 2 * SKETCH), pa.array(sketch.reshape(-1).view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * PARITY), pa.array(parity.reshape(-1).view(np.int64))),
                        *[c.slice(a, b - a) for c in batch.columns[2:]],
                    ],
                    names=["doc_id", "n_shingles", "node", "bands", "sketch", "parity", *batch.schema.names[2:]],
                )

    return sign


def _set_maker(k: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, found, bounds in shingle_sets(batch.column(0), k):
                names = _identity(found, bounds).view(np.int64)
                raw = found.astype("<u8").tobytes()
                blobs = [raw[8 * x : 8 * y] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(blobs, pa.binary())], names=["node", "set"])

    return make


def _confirmer(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"])
            yield out.filter(pa.array(ok, pa.bool_()))

    return confirm


class NearDuplicates:
    """Shingle classes of ``docs`` and their confirmed components.

    ``rows``: ``doc_id, n_shingles, node`` per document; ``groups()``: ``node, component_id, group`` per class.
    """

    def __init__(self, docs: DataFrame, k: int, percent: int, rows: int, bands: int, extra: tuple[str, ...]):
        self.docs, self.k, self.percent = docs.select("doc_id", "text"), k, percent
        names = T.StructType([docs.schema["doc_id"]]).add("n_shingles", "long").add("node", "long").add("bands", T.ArrayType(T.LongType())).add("sketch", T.ArrayType(T.LongType())).add("parity", T.ArrayType(T.LongType()))
        schema = T.StructType(names.fields + [docs.schema[c] for c in extra])
        self.signed = settle(docs.select("doc_id", "text", *extra).mapInArrow(trimmed(_signer(k, rows, bands)), schema))
        self.rows = self.signed.drop("bands", "sketch", "parity")
        # one row per class, with the document that stands for it; copies have equal sketches and parities
        full = self.signed.where("n_shingles > 0")
        sketch = [F.min(F.get("sketch", F.lit(i))).alias(f"s{i}") for i in range(2 * SKETCH)]
        parity = F.first("parity").alias("parity")
        self.classes = settle(full.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"), F.first("bands").alias("bands"), parity, *sketch))
        alike = 0.25 + 0.75 * percent / 100
        values = 64 * SKETCH
        self.apart = values - int(values * alike - SIGMAS * (values * alike * (1 - alike)) ** 0.5)  # sketched values that may differ

    def _buckets(self) -> DataFrame:
        """``key, node, n``: the members of buckets that have two classes at least."""
        lone = self.classes.select("node", "n", F.explode("bands").alias("key"))
        several = lone.groupBy("key").agg(F.count("*").alias("_c")).where("_c > 1").select("key")
        return settle(lone.join(several, "key"))

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """The links among the candidate pairs ``a, b``, on the full sets of their standing documents."""
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = settle(few(nodes.join(self.bucketed, "node").select("doc_id", "node"), 2 * pairs.count()))
        same = self.docs["doc_id"].eqNullSafe(wanted["doc_id"])
        made = self.docs.join(sized(wanted.select("doc_id").distinct(), 1_000_000), same, "left_semi").select("text")
        made = made.mapInArrow(trimmed(_set_maker(self.k)), "node long, set binary")
        # one doc_id can carry several texts: keep the sets of wanted classes, one of each
        made = made.join(sized(wanted.select("node"), 1_000_000), "node", "left_semi")
        sets = settle(made.groupBy("node").agg(F.first("set").alias("set")))
        # many pairs of few sets: the sets travel once, if they are small together
        size = sets.agg(F.sum(F.octet_length("set") + 64)).first()[0] or 0
        sent = F.broadcast(sets) if size <= SETS else sets
        one = sent.select(F.col("node").alias("a"), F.col("set").alias("_x"))
        two = sent.select(F.col("node").alias("b"), F.col("set").alias("_y"))
        full = pairs.join(one, "a").join(two, "b").select("a", "b", "_x", "_y")
        return settle(full.mapInArrow(trimmed(_confirmer(self.percent)), "a long, b long"))

    def _of(self, name: str, bands: bool = False) -> DataFrame:
        """The classes with columns named after ``name``: ``x, x_n, x_s0, ...``, with ``bands`` also these and ``x_p0, ...``."""
        columns = ["n", *["bands"] * bands, *(f"s{i}" for i in range(2 * SKETCH))]
        parity = [F.get("parity", F.lit(i)).alias(f"{name}_p{i}") for i in range(PARITY if bands else 0)]
        return self.bucketed.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns], *parity)

    def _alike(self, n, m):
        """Sizes that allow the similarity at all."""
        return F.least(n, m) * 100 >= F.greatest(n, m) * self.percent

    def _apart(self):
        """The number of sketched values in which ``x`` and ``y`` differ; near ones in at most ``apart``."""
        differ = [F.col(f"x_s{i}").bitwiseXOR(F.col(f"y_s{i}")) for i in range(2 * SKETCH)]
        return sum((F.bit_count(differ[i].bitwiseOR(differ[SKETCH + i])) for i in range(SKETCH)), F.lit(0))

    def _can_link(self):
        """Whether ``x`` and ``y`` can have the similarity: shingles in one set only are as many as unequal parities at least."""
        differ = sum((F.bit_count(F.col(f"x_p{i}").bitwiseXOR(F.col(f"y_p{i}"))) for i in range(PARITY)), F.lit(0))
        both = F.col("x_n") + F.col("y_n")
        return (both - differ) * 100 >= (both + differ) * self.percent

    def links(self) -> DataFrame | None:
        """Confirmed links ``a, b`` between classes that span all components."""
        buckets = self._buckets()
        self.members = buckets.count()
        self.bucketed = settle(self.classes.join(buckets.select("node").distinct(), "node", "left_semi"))
        found, tested, step, pays = None, None, 0, True
        while True:
            part = self._open(buckets, found, step)
            if part.isEmpty():
                return found
            if pays:  # each member against the nearest of its buckets' centres
                met = part.where(self._alike(F.col("n"), F.col("centre.n")) & (F.col("comp") != F.col("centre.comp")))
                pairs = few(met.select(F.col("node").alias("x"), F.col("centre.node").alias("y")).distinct(), self.members)
                pairs = pairs if tested is None else pairs.join(few(tested, self.members), (F.col("a") == F.least("x", "y")) & (F.col("b") == F.greatest("x", "y")), "left_anti")
                pairs = pairs.join(self._of("x"), "x").join(self._of("y"), "y").withColumn("_apart", self._apart()).where(F.col("_apart") <= self.apart)
                pairs = pairs.groupBy("x").agg(F.min_by("y", F.struct("_apart", "y")).alias("y"))
            else:  # all pairs that still lie in different components
                x, y = (part.select("key", F.col("node").alias(v), F.col("comp").alias(f"{v}_c")).join(self._of(v, True), v) for v in "xy")
                once = F.array_min(F.array_intersect("x_bands", "y_bands")) == F.col("key")
                pairs = x.join(y, "key").where((F.col("x_c") < F.col("y_c")) & self._alike(F.col("x_n"), F.col("y_n")) & (self._apart() <= self.apart) & self._can_link() & once)
            pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
            pairs = settle(few(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), self.members))
            tested = pairs if tested is None else tested.unionByName(pairs)
            new = self._confirmed(pairs)
            found = new if found is None else found.unionByName(new)
            if not pays:
                return found
            step, pays = step + 1, new.count() * PAYS >= max(1, pairs.count())

    def _open(self, buckets: DataFrame, found: DataFrame | None, step: int) -> DataFrame:
        """The members of buckets that lie in several components of the links ``found``, with the bucket's centre."""
        if found is None:
            part = buckets.withColumn("comp", F.col("node"))
        else:
            named = settle(components(found))
            part = few(buckets.join(named, "node", "left"), self.members).withColumn("comp", F.coalesce("component", "node")).drop("component")
        centre = F.min(F.struct(F.xxhash64("node", "key", F.lit(step)).alias("_o"), "node", "n", "comp")).alias("centre")
        open_ = few(part.groupBy("key").agg(F.min("comp").alias("_l"), F.max("comp").alias("_h"), centre), self.members)
        return settle(few(part.join(open_.where("_l <> _h").select("key", "centre"), "key"), self.members))

    def groups(self) -> DataFrame:
        """``node, component_id`` of every class, and ``group``, the name of its component (never null)."""
        links = self.links()
        if links is None:
            return self.classes.select("node", F.col("doc_id").alias("component_id"), F.col("node").alias("group"))
        named = settle(components(links))
        lowest = self.classes.join(named, "node").groupBy("component").agg(F.min("doc_id").alias("_lowest"))
        every = self.classes.join(named, "node", "left").join(sized(settle(lowest)), "component", "left")
        return every.select("node", F.coalesce("_lowest", "doc_id").alias("component_id"), F.coalesce("component", "node").alias("group"))


def near_duplicates(
    docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS, extra: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per document, and its columns named in ``extra`` (``group`` is its component's)."""
    work = NearDuplicates(docs, k, percent, rows, bands, tuple(c for c in extra if c != "group"))
    groups = settle(work.groups())
    out = work.rows.join(groups, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), *extra)


def deduplicate(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the smallest doc_id.

    A row is known by its doc_id and its text's hash. Of several texts under a group's smallest
    doc_id (or without any, if all are null) the one with the smallest hash stays; rows equal in
    both leave the first in the order of their other columns.
    """
    tag = F.xxhash64(F.coalesce("text", F.lit("")))
    plan = settle(near_duplicates(docs.select("doc_id", "text", tag.alias("_tag")), k, percent, extra=("_tag", "group")))
    known = plan.groupBy("doc_id", "_tag").agg(F.min("kept").alias("_kept"), F.count("*").alias("_n"), F.max("n_shingles").alias("_s"), F.min("group").alias("group"))
    # groups with several texts under the doc_id that stays
    rivals = plan.where("kept and n_shingles > 0").groupBy("group").agg(F.min("_tag").alias("_best"), F.max("_tag").alias("_last"))
    rivals = sized(settle(rivals.where("_best <> _last").drop("_last")), 1_000_000)
    known = known.join(rivals, "group", "left").withColumn("_kept", F.expr("_kept and (_best is null or _tag = _best)"))
    marks = known.where("not _kept or (_n > 1 and _s > 0)").select(F.col("doc_id").alias("_id"), F.col("_tag").alias("_mark"), "_kept")
    marks = sized(settle(marks), 1_000_000)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), "doc_id", tag.alias("_tag"))
    rows = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tag") == F.col("_mark")), "left")
    rows = rows.where("_kept is null or _kept")
    if not marks.where("_kept").isEmpty():
        order = W.partitionBy("_id", "_mark").orderBy("_doc")
        first = rows.where("_kept").withColumn("_row", F.row_number().over(order)).where("_row = 1").drop("_row")
        rows = rows.where("_kept is null").unionByName(first)
    return rows.select("_doc.*")


def op10_minmax_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, k=2)


# plain sets and every pair that shares a shingle: for tables of the size that the oracle reads
SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 1], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM texts WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), linked AS (
    SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * common >= 80 * (a.n + b.n - common)
), links AS (
    SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked
), reach(doc_id, far) AS (
    SELECT doc_id, doc_id FROM texts
    UNION
    SELECT reach.doc_id, y FROM reach JOIN links ON far = x
), components AS (
    SELECT doc_id, min(far) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""
