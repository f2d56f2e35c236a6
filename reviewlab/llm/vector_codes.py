"""Vector compression to a byte per part: a codebook for every part, found by member-resident Lloyd.

Components become integers floor(1024 x), vectors are cut into ``PARTS`` parts, and a part's
codebook begins as that part of the vectors with the smallest ids. A part's row lives where its
(position, entry, salt) says: the members are a table in as many buckets, so the next round reads
every bucket in one task, adds up its own members' sums (a codebook's worth per task leaves it) and
compares them with the new codebooks. Members that keep their entry are written back to their
bucket without a shuffle; only those that change it are sent to another. The salt is a hash of the
row and their number grows with the rows, so an entry that a third of all parts chose is spread over
as many owners as its size asks for. All arithmetic is on integers: results don't depend on the
order of the rows.

Defined results: rows whose vector is null or holds a null, NaN or infinite component are left out.
The dimension is that of the kept vector with the smallest id (without ids: of the least vector);
where ``PARTS`` doesn't divide it, and for vectors of another length, codes and error are null.
An id in several rows starts one entry, its least vector's; null ids start none, unless no row has
an id; with fewer than ``entries`` ids the codebooks are shorter. Components are held to +-2^26, so
that squared distances are exact in 64 bits. Every row gets its own code. An empty table has no
rows. Columns that clash can't: only the named ones are read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.arrays import one_array
from reviewlab.llm.frames import shipped, written
from reviewlab.session import scratch_path

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
MOST = 1 << 26
# A salt for every so many parts of a position.
SALT_ROWS = 50_000
# Below this, squared distances are whole numbers that double precision holds.
EXACT = 1 << 22
# Parts compared with a codebook at a time.
ROWS = 8_192

Codebooks = list[np.ndarray]  # by position: entries x components


def integers(vector: Column) -> Column:
    """floor(1024 x) of all components; null if one is null or not finite."""
    scaled = F.transform(vector, lambda x: x.cast("double") * SCALE)
    sound = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = F.transform(
        scaled,
        lambda x: F.floor(F.greatest(F.least(x, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("int"),
    )
    return F.when(sound, held)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every part; of equally near entries the first."""
    entry, error = np.empty(len(parts), np.int32), np.empty(len(parts), np.int64)
    most = max(np.abs(parts).max(initial=0), np.abs(book).max(initial=0))
    exact = most < EXACT and parts.shape[1] * (2 * int(most)) ** 2 < 1 << 53
    kind = np.float64 if exact else np.int64
    book = book.astype(kind)
    squares = (book * book).sum(1)
    for a in range(0, len(parts), ROWS):
        x = parts[a : a + ROWS].astype(kind)
        far = squares - 2 * (x @ book.T)
        entry[a : a + ROWS] = at = far.argmin(1)
        error[a : a + ROWS] = far[np.arange(len(x)), at] + (x * x).sum(1)
    return entry, error


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(one_array(column).flatten()).reshape(-1, width).astype(np.int64)


def _assign(books: Codebooks, kind: str, take) -> Column:
    """A column function of (position, part): the nearest entry of the position's codebook."""
    width = books[0].shape[1]

    @F.arrow_udf(kind)
    def assigned(position: pa.Array, part: pa.Array) -> pa.Array:
        where, parts = np.asarray(position), _matrix(part, width)
        entry, error = np.empty(len(parts), np.int32), np.empty(len(parts), np.int64)
        for p in np.unique(where):
            of = where == p
            entry[of], error[of] = nearest(parts[of], books[p])
        return take(entry, error)

    return assigned(F.col("position"), F.col("part"))


def entries(books: Codebooks) -> Column:
    return _assign(books, "int", lambda entry, error: pa.array(entry))


def entries_and_errors(books: Codebooks) -> Column:
    def take(entry: np.ndarray, error: np.ndarray) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(entry), pa.array(error)], ["entry", "error"])

    return _assign(books, "struct<entry:int,error:bigint>", take)


def first_books(rows: DataFrame, width: int, count: int) -> Codebooks:
    """The parts of the vectors with the smallest ids, one vector of each id."""
    ids = rows.select("id").filter("id is not null").distinct().orderBy("id").limit(count)
    wanted = [r.id for r in ids.collect()]
    if wanted:
        chosen = rows.filter(F.col("id") <= wanted[-1]).groupBy("id").agg(F.min("ints").alias("ints"))
    else:
        chosen = rows.select(F.lit(0).alias("id"), "ints").distinct().orderBy("ints").limit(count)
    found = [r.ints for r in sorted(chosen.collect(), key=lambda r: (r.id, r.ints))]
    whole = np.array(found, np.int64).reshape(len(found), PARTS, width)
    return [whole[:, p] for p in range(PARTS)]


def updated(members: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry as the floored mean of its members; one without members stays.

    Tasks add up what they hold; a row per position and entry goes to the driver.
    """
    width = books[0].shape[1]
    totals = [F.sum(F.get("part", F.lit(i))).alias(f"s{i}") for i in range(width)]
    sums = members.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n"), *totals).collect()
    books = [b.copy() for b in books]
    for position, entry, n, *total in sums:
        books[position][entry] = np.array(total, np.int64) // n
    return books


class Members:
    """The table of parts, in buckets by (position, entry, salt); the owner drops it at the end."""

    KEYS = ("position", "entry", "salt")

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets, self.name = spark, buckets, ""

    def settle(self, *rows: DataFrame) -> DataFrame:
        """Write the members anew; each part of ``rows`` is in its bucket's task already."""
        old, self.name = self.name, f"members_{uuid.uuid4().hex}"
        whole = rows[0]
        for more in rows[1:]:
            whole = whole.union(more)
        writer = whole.write.format("parquet").option("path", scratch_path(self.spark, "members"))
        writer.bucketBy(self.buckets, *self.KEYS).saveAsTable(self.name)
        self.drop(old)
        return self.spark.table(self.name)

    def sent(self, rows: DataFrame) -> DataFrame:
        """Rows on their way to the task of their bucket."""
        return rows.repartition(self.buckets, *self.KEYS)

    def drop(self, name: str | None = None) -> None:
        if name is None:
            name = self.name
        if name:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def fit(parts: DataFrame, books: Codebooks, salts: int, rounds: int = ROUNDS) -> tuple[Codebooks, DataFrame]:
    """(codebooks, (row, position, entry, error)) after some rounds of Lloyd's algorithm."""
    spark = parts.sparkSession
    owner = Members(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = ["row", "position", "entry", "salt", "part"]
    scan = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(scan)
    spark.conf.set(scan, "false")  # a bucket is one task even where no join asks for it
    try:
        salt = F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")
        placed = parts.withColumns({"salt": salt, "entry": entries(books)}).select(columns)
        members = owner.settle(owner.sent(placed))
        for left in range(rounds - 1, -1, -1):
            books = updated(members, books)
            if not left:
                break
            moved = members.withColumn("to", entries(books))
            stay = moved.filter("to = entry").select(columns)
            go = moved.filter("to <> entry").withColumn("entry", F.col("to")).select(columns)
            members = owner.settle(stay, owner.sent(go))
        done = members.withColumn("found", entries_and_errors(books))
        done = written(done.select("row", "position", "found.entry", "found.error"), "codes")
    finally:
        spark.conf.set(scan, before)
        owner.drop()
    return books, done


def digest(books: Codebooks) -> str:
    """The hash of all entries' components, in the order of part, entry and component."""
    numbers = (str(x) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def encode(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(key, label, codes, error, codebooks_sha256): a code per part and the whole squared error."""
    rows = shipped(df).select(
        df[key].alias("id"), df[label].alias("label"), integers(df[vector]).alias("ints")
    )
    rows = rows.filter("ints is not null").withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "vectors")
    first = rows.select("id", "ints").orderBy(F.asc_nulls_last("id"), "ints").first()
    size = len(first.ints) if first else 0
    width = size // PARTS
    names = [F.col("id").alias(key), "label", "codes", "error"]
    odd = rows.withColumns(
        {"codes": F.lit(None).cast("array<int>"), "error": F.lit(None).cast("long")}
    )
    if not width or size % PARTS:
        return odd.select(*names, F.lit(digest([])).alias("codebooks_sha256"))
    fitting = rows.filter(F.size("ints") == size)
    books = first_books(fitting, width, entries)
    salts = rows.count() // SALT_ROWS + 1
    cut = F.posexplode(
        F.array(*(F.slice("ints", p * width + 1, width) for p in range(PARTS)))
    ).alias("position", "part")
    books, done = fit(fitting.select("row", cut), books, salts, rounds)
    codes = F.transform(
        F.array_sort(F.collect_list(F.struct("position", "entry"))), lambda x: x["entry"]
    )
    whole = done.groupBy("row").agg(codes.alias("codes"), F.sum("error").alias("error"))
    whole = rows.drop("ints").join(whole, "row")
    odd = odd.filter(F.size("ints") != size)
    both = whole.select(*names).union(odd.select(*names))
    return both.withColumn("codebooks_sha256", F.lit(digest(books)))
