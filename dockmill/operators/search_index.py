"""Boolean substring search and facets over a stored index.

Building writes three tables to one folder:

* ``texts``: the rows with a number each, in parts of ``PART_BITS`` bits of numbers,
  which are folders, so a read of some parts touches no others;
* ``postings``: (``gram``, ``block``, ``mask``): which of the 64 rows of a block have the
  trigram.  Each file is of the texts of one task and sorted by ``gram``, so nothing
  is exchanged, and of each file a query reads the pages of its grams;
* ``facets``: (``facet``, ``value``, ``block``, ``mask``), the same for the values of facets.

A query is worked out on postings alone, block by block: of its terms' grams only
those are read (the filter reaches the scan, and the files are sorted), a term of
more than three bytes may be where all its grams are, a shorter one surely is
where a gram begins with it.  Groups, alternatives and negations combine these
masks to rows that surely match and rows that may.  Only the latter have their
texts read and compared.  Facets are masks too: values of one are ORed, facets and
search are ANDed, and rows are counted by value from the bits.

Defined results: a null text is empty; an empty query matches all rows; repeated rows
are rows of their own; an empty table gives no rows; the columns of the rows come
back as they were, except that one named like the index's own is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmill.operators.explore import Token, matches
from dockmill.plans.shared import materialize, new_path, shuffles_dropped, small

BLOCK_BITS = 6
PART_BITS = 14
CHUNK = 1 << 22  # bytes whose trigrams are sorted at once
MOST = 200_000  # candidates that are broadcast; more are joined by a shuffle
OWN = ("__n", "__part", "__text")
POSTINGS = "gram int, block long, mask long"
FACETS = "facet string, value string, block long, mask long"


def _grams(texts: list[bytes], number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(trigrams, masks) of the texts of one block; a text ends with two zero bytes, so that each of its bytes begins a trigram."""
    data = np.frombuffer(b"".join(t + b"\0\0" for t in texts) or b"\0\0", dtype=np.uint8).astype(np.int32)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    row = np.repeat(number, size + 2)
    ends = np.cumsum(size + 2)
    real = np.ones(len(data), dtype=bool)
    real[ends - 1] = real[ends - 2] = False
    found = []
    for at in range(0, len(data), CHUNK):
        d, keep = data[at : at + CHUNK + 2], real[at : at + CHUNK]
        keep = keep[: max(len(d) - 2, 0)]
        gram = (d[:-2] << 16 | d[1:-1] << 8 | d[2:])[: len(keep)]
        found.append(np.unique((gram << BLOCK_BITS | row[at : at + len(keep)])[keep]))
    key = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
    gram = key >> BLOCK_BITS
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else gram
    bit = np.left_shift(np.uint64(1), (key & 63).astype(np.uint64))
    return gram[first].astype(np.int32), (np.bitwise_or.reduceat(bit, first) if len(first) else bit).view(np.int64)


def _postings(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("__n").to_numpy()
            text = batch.column("__text").cast(pa.binary()).to_pylist()
            border = [0, *(np.flatnonzero(np.diff(n >> BLOCK_BITS)) + 1).tolist(), len(n)]
            for a, b in zip(border, border[1:], strict=False):
                if b > a:
                    gram, mask = _grams(text[a:b], (n[a:b] & 63).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(np.full(len(gram), n[a] >> BLOCK_BITS)), pa.array(mask)], names=["gram", "block", "mask"])

    return texts.select("__n", "__text").mapInArrow(run, POSTINGS)


@dataclass(frozen=True)
class Need:
    """A token as ranges of grams that must all be met; ``exact`` if that is enough for the text to have it."""

    ranges: tuple[tuple[int, int], ...]
    exact: bool

    @classmethod
    def of(cls, value: str) -> Need:
        b = value.lower().encode()
        if len(b) > 3:
            grams = dict.fromkeys(int.from_bytes(b[i : i + 3]) for i in range(len(b) - 2))
            return cls(tuple((g, g) for g in grams), False)
        least = int.from_bytes(b.ljust(3, b"\0"))
        return cls(((least, least + (1 << 8 * (3 - len(b))) - 1),), 0 not in b)


def _combined(tokens: list[Token], have: dict[Token, Column | int], none, every):
    """(rows that surely match, rows that may) from the masks of where each token may be."""
    both = (every, every)
    for g in dict.fromkeys(t.group for t in tokens):
        members = [t for t in tokens if t.group == g]
        sure, maybe = every, every
        for t in (t for t in members if t.negated):
            sure, maybe = sure & ~have[t], maybe & (~have[t] if Need.of(t.value).exact else every)
        if positive := [t for t in members if not t.negated]:
            sure = sure & reduce(lambda a, b: a | b, [have[t] if Need.of(t.value).exact else none for t in positive])
            maybe = maybe & reduce(lambda a, b: a | b, [have[t] for t in positive])
        both = (both[0] & sure, both[1] & maybe)
    return both


def _bit() -> Column:
    """The bit of a row's number in its block."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__n").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int"))


class _Mask:
    """A long column under the operators of Python's whole numbers."""

    def __init__(self, column: Column):
        self.column = column

    def __and__(self, other: _Mask) -> _Mask:
        return _Mask(self.column.bitwiseAND(other.column))

    def __or__(self, other: _Mask) -> _Mask:
        return _Mask(self.column.bitwiseOR(other.column))

    def __invert__(self) -> _Mask:
        return _Mask(F.bitwise_not(self.column))


class TextIndex:
    """An index in a folder; see :meth:`build` and :meth:`search`."""

    def __init__(self, spark: SparkSession, path: str, part_bits: int = PART_BITS, schema: T.StructType | None = None):
        """``schema``: of the texts, else read from their files, of which an empty index has none."""
        self.path, self.part_bits = path, part_bits
        self.texts = (spark.read.schema(schema) if schema else spark.read).parquet(f"{path}/texts")
        self.postings = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
        self.facets = spark.read.schema(FACETS).parquet(f"{path}/facets")

    @classmethod
    def build(cls, rows: DataFrame, text: Column, path: str | None = None, *, keep: list[str] | None = None, facets: dict[str, Column] | None = None, part_bits: int = PART_BITS) -> TextIndex:
        """Index ``text`` (as it is, so lower-cased by the caller) of ``rows``; ``path``: a new folder, by default in the shared one.

        ``keep``: columns to store and give back, by default all.  ``facets``: arrays
        of texts over these columns; a null one has no values.
        """
        spark, path = rows.sparkSession, path or new_path(rows.sparkSession, "search-index")
        keep = rows.columns if keep is None else keep
        if clash := [c for c in keep if c.lower() in OWN]:
            raise ValueError(f"columns of the index: {clash}")
        numbered = rows.select(*keep, F.coalesce(text, F.lit("")).alias("__text"), F.monotonically_increasing_id().alias("__n")).withColumn("__part", F.shiftright("__n", part_bits))
        with shuffles_dropped(spark):
            numbered.write.option("compression", "zstd").partitionBy("__part").parquet(f"{path}/texts")
            stored = spark.read.schema(numbered.schema).parquet(f"{path}/texts")
            _postings(stored).sortWithinPartitions("gram", "block").write.option("compression", "zstd").parquet(f"{path}/postings")
            parts = [stored.select(F.lit(name).alias("facet"), F.explode(F.array_distinct(values)).alias("value"), "__n") for name, values in (facets or {}).items()]
            valued = reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], "facet string, value string, __n long")
            bits = valued.groupBy("facet", "value", F.shiftright("__n", BLOCK_BITS).alias("block")).agg(F.bit_or(_bit()).alias("mask"))
            bits.sortWithinPartitions("facet", "value", "block").write.option("compression", "zstd").parquet(f"{path}/facets")
        return cls(spark, path, part_bits, numbered.schema)

    def masks(self, tokens: list[Token], wanted: dict[str, list[str]] | None = None) -> DataFrame:
        """(``block``, ``sure``, ``maybe``): the rows that surely match, and others whose texts must be read.

        ``wanted``: by facet the values of which a row must have one.
        """
        if not wanted:
            return self._searched(tokens)
        read = self.facets.where(reduce(lambda a, b: a | b, [(F.col("facet") == name) & F.col("value").isin(list(values)) for name, values in wanted.items()]))
        met = read.groupBy("block").agg(*(F.bit_or(F.when(F.col("facet") == name, F.col("mask"))).alias(f"f{i}") for i, name in enumerate(wanted)))
        one = reduce(lambda a, b: a & b, [_Mask(F.coalesce(F.col(f"f{i}"), F.lit(0).cast("long"))) for i in range(len(wanted))])
        met = met.select("block", one.column.alias("had")).where("had <> 0")
        if not tokens:
            return met.select("block", F.col("had").alias("sure"), F.lit(0).cast("long").alias("maybe"))
        both = self._searched(tokens).join(met, "block")
        return both.select("block", F.col("sure").bitwiseAND(F.col("had")).alias("sure"), F.col("maybe").bitwiseAND(F.col("had")).alias("maybe"))

    def _searched(self, tokens: list[Token]) -> DataFrame:
        needs = {t: Need.of(t.value) for t in tokens}
        ranges = [*dict.fromkeys(r for n in needs.values() for r in n.ranges)]
        within = {r: F.col("gram") == r[0] if r[0] == r[1] else F.col("gram").between(*r) for r in ranges}
        single = F.col("gram").isin([r[0] for r in ranges if r[0] == r[1]])
        read = self.postings.where(reduce(lambda a, b: a | b, [single, *(within[r] for r in ranges if r[0] != r[1])]))
        met = read.groupBy("block").agg(*(F.bit_or(F.when(within[r], F.col("mask"))).alias(f"m{i}") for i, r in enumerate(ranges)))
        if _combined(tokens, dict.fromkeys(tokens, 0), 0, -1)[1]:  # rows without any of the grams may match
            there = self.texts.groupBy(F.shiftright("__n", BLOCK_BITS).alias("block")).agg(F.bit_or(_bit()).alias("all"))
            met = there.join(met, "block", "left")
        else:
            met = met.withColumn("all", F.lit(-1).cast("long"))
        one = {r: _Mask(F.coalesce(F.col(f"m{i}"), F.lit(0).cast("long"))) for i, r in enumerate(ranges)}
        have = {t: reduce(lambda a, b: a & b, [one[r] for r in n.ranges]) for t, n in needs.items()}
        sure, maybe = _combined(tokens, have, _Mask(F.lit(0).cast("long")), _Mask(F.lit(-1).cast("long")))
        there = _Mask(F.col("all"))
        return met.select("block", (sure & there).column.alias("sure"), (maybe & ~sure & there).column.alias("maybe"))

    def _rows(self, masks: DataFrame, mask: str, columns: list[str]) -> DataFrame:
        """``columns`` of the rows whose bit is set; parts without any are not read."""
        bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(mask, i) == 1)
        found = masks.where(F.col(mask) != 0).select("block", F.explode(bits).alias("bit")).select((F.col("block") * (1 << BLOCK_BITS) + F.col("bit")).alias("__n"))
        found = small(found.withColumn("__part", F.shiftright("__n", self.part_bits)), MOST)
        return self.texts.select(*dict.fromkeys([*columns, "__n", "__part"])).join(found, ["__part", "__n"], "left_semi").select(*columns)

    def _found(self, tokens: list[Token], wanted: dict[str, list[str]] | None, columns: list[str]) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
        """(the masks, ``columns`` of the sure rows if there can be any, of those that were read and match if any had to be)."""
        masks = materialize(self.masks(tokens, wanted), "masks")
        sure = _combined(tokens, {t: 0 if t.negated else -1 for t in tokens}, 0, -1)[0]  # 0 if no row can be
        read = not all(Need.of(t.value).exact for t in tokens)
        return masks, self._rows(masks, "sure", columns) if sure else None, self._rows(masks, "maybe", [*columns, "__text"]).where(matches(F.col("__text"), tokens)).drop("__text") if read else None

    def search(self, tokens: list[Token], wanted: dict[str, list[str]] | None = None) -> DataFrame:
        """The indexed rows that match the tokens of a parsed query and have one of the wanted values of each facet."""
        columns = [c for c in self.texts.columns if c not in OWN]
        wanted = {name: values for name, values in (wanted or {}).items() if values}
        if not tokens and not wanted:
            return self.texts.select(*columns)
        kinds = [k for k in self._found(tokens, wanted, columns)[1:] if k is not None]
        return reduce(DataFrame.unionAll, kinds or [self.texts.select(*columns).limit(0)])

    def counts(self, facet: str, tokens: list[Token] = (), wanted: dict[str, list[str]] | None = None) -> DataFrame:
        """(``value``, ``n``): how many rows of a search have each value of a facet, from bits alone but for texts that must be read."""
        values = self.facets.where(F.col("facet") == facet)
        wanted = {name: values for name, values in (wanted or {}).items() if values}
        if not tokens and not wanted:
            return values.groupBy("value").agg(F.sum(F.bit_count("mask")).alias("n"))
        masks, _, read = self._found(list(tokens), wanted, ["__n"])
        found = masks.select("block", F.col("sure").alias("bits"))
        if read is not None:
            found = found.unionAll(read.groupBy(F.shiftright("__n", BLOCK_BITS).alias("block")).agg(F.bit_or(_bit()))).groupBy("block").agg(F.bit_or("bits").alias("bits"))
        n = F.bit_count(F.col("mask").bitwiseAND(F.col("bits")))
        return values.join(found, "block").groupBy("value").agg(F.sum(n).alias("n")).where("n > 0")


PAIR = "\x01"  # between the two halves of a value


def comment_facets() -> dict[str, Column]:
    """Facets of comments: ``theme`` (code and score), ``entity`` (category and label), ``type``."""
    scores = F.map_entries(F.coalesce("theme_scores", F.create_map().cast("map<string,int>")))
    return {
        "theme": F.transform(scores, lambda e: F.concat(e["key"], F.lit(PAIR), e["value"].cast("string"))),
        "entity": F.transform(F.col("entities"), lambda e: F.concat(e["category"], F.lit(PAIR), e["label"])),
        "type": F.when(F.col("submitter_type").isNotNull(), F.array("submitter_type")),
    }


def wanted_facets(*, themes: list[str] = (), entities: list[tuple[str, str]] = (), types: list[str] = (), max_score: int = 2) -> dict[str, list[str]]:
    """What :func:`dockmill.operators.explore.facets` takes, as values of :func:`comment_facets`."""
    return {"theme": [f"{t}{PAIR}{s}" for t in themes for s in range(1, max_score + 1)], "entity": [PAIR.join(e) for e in entities], "type": list(types)}


_built: dict[tuple, TextIndex] = {}


def index_of(rows: DataFrame, text: Column, of: object, **how) -> TextIndex:
    """The index of ``rows``, built once an application as long as the files they come from stay what they are.  ``of``: tells indexes over the same files apart; ``how``: see :meth:`TextIndex.build`."""
    spark = rows.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for name in sorted(rows.inputFiles()):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        files.append((name, status.getLen(), status.getModificationTime()))
    key = (spark.sparkContext.applicationId, of, tuple(files))
    if key not in _built:
        _built[key] = TextIndex.build(rows, text, **how)
    return _built[key]
