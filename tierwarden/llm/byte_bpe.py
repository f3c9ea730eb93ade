"""Byte-level BPE: ranked merges folded over the bytes of distinct words with higher-order functions.

A text is cut into pieces by the tokenizer's pattern. A token is written as one character (``char_of`` its
rank), so a piece's byte array is a string of single-byte tokens, and characters compare as
their ranks do. The rank file becomes one constant of the plan: an array of buckets (CRC-32 of two tokens), each a string of
entries: a mark, two tokens and the token they make. Each token has one such pair: the last two parts when its own
bytes are merged. No other pair of the same bytes can ever stand side by side, since both its ends would have been bounds all along.

The merges of a piece are a fold (``aggregate``). Its state is the string of parts and the string of
what every adjacent pair makes; each step takes the least character of the latter, joins the leftmost such
pair and looks up its two new neighbours. Where every token's rank lies above those of its two parts, as training gives
them, ranks are joined in order, and a long piece (over ``LONG`` bytes) is folded the other way round: over the ranked merges whose
token its bytes hold, each replacing all its pairs from left to right, in time linear in the piece.

``word_table`` runs the fold once for each of the most common distinct pieces of the whole input, those
whose count reaches a threshold taken from a histogram of counts.
That table has a fixed bound (``words``) and is broadcast. ``encode`` writes a text as numbers of table rows and a
list of its distinct other pieces, folds only those, and puts the ids in order; texts stay where they
are, nothing is shuffled, and the table changes the cost of a row, never its ids. Decoding concatenates
the tokens' binary pieces.

Defined results: null and empty texts give an empty id list; ids are those of greedy ranked
merging without special tokens; a piece of n bytes up to ``LONG`` costs n steps over strings of at
most n parts. Input columns are kept; ``ids`` replaces a column of that name.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwarden.llm.storage import stored

BUCKETS = 1 << 15
WORDS = 3 << 18
RULES = "__rules"
LONG = 512         # bytes
SHIFT = 256        # code points below are those of the bytes
END = "\u0001"     # before the first and after the last part; no pair holds it
MARK, LINE = "\u0002", "\u0003"      # before every entry and between entries of the rules
NONE = "\U0010ffff"    # what a pair without a token makes; greater than every token
MOST = 0x10ffff - 0x800 - SHIFT


def char_of(rank: int) -> str:
    """A character for each rank, in the order of ranks, past those of the bytes and the surrogates."""
    code = rank + SHIFT
    return chr(code if code < 0xD800 else code + 0x800)


def _rank_of(char: Column) -> Column:
    code = F.ascii(char)
    return code - F.when(code < 0xD800, F.lit(SHIFT)).otherwise(F.lit(SHIFT + 0x800))


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, f.read().splitlines()))}


def merges(ranks: dict[bytes, int]) -> Iterable[tuple[int, int, int]]:
    """The ranks of the two parts a token is joined from, and its own; tokens that are never reached are left out."""
    for token, rank in ranks.items():
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            least, at = min((ranks.get(parts[i] + parts[i + 1], MOST), i) for i in range(len(parts) - 1))
            if least == MOST:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            yield ranks[parts[0]], ranks[parts[1]], rank


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what runs inside, as they were afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _list(lists: pa.ListArray, numbers: bool = True) -> tuple[np.ndarray, np.ndarray | pa.Array]:
    """Bounds and values of a list column."""
    bounds = lists.offsets.to_numpy().astype(np.int64) if len(lists) else np.zeros(1, np.int64)
    values = lists.flatten()
    return bounds - bounds[0], values.to_numpy(zero_copy_only=False) if numbers else values


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that what is worked out for a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _char(text: Column, at: Column) -> Column:
    return F.substring(text, at, F.lit(1))


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if max(ranks.values()) >= MOST or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"ranks must lie below {MOST} and hold all single bytes")
        self.pattern = pattern
        joins = sorted(merges(ranks), key=lambda x: x[2])
        self.in_order = all(max(left, right) < rank for left, right, rank in joins)
        # a look-up that finds nothing ends at the third character
        self.buckets = buckets = [END * 2 + NONE] * BUCKETS
        for left, right, rank in joins:
            two = char_of(left) + char_of(right)
            buckets[zlib.crc32(two.encode()) % BUCKETS] += MARK + two + char_of(rank)
        spelled = {rank: "".join(char_of(ranks[bytes([b])]) for b in token) for token, rank in ranks.items()}
        self.joins = LINE.join(MARK.join((spelled[rank], char_of(left) + char_of(right), char_of(rank))) for left, right, rank in joins)
        self.bytes = "".join(map(chr, range(256)))
        self.singles = "".join(char_of(ranks[bytes([b])]) for b in range(256))
        self.tokens = {rank: token for token, rank in ranks.items()}

    def rules(self, spark: SparkSession) -> Column:
        """The pair table and the ranked merges, as a constant of the plan.

        A scalar subquery on a stored row: its value is one compact block in every task, and the plan's text names it only.
        To be added to a frame as the column ``RULES``, and used once, in ``folded``: the optimizer then puts the constant there.
        """
        row = pa.table({"pairs": pa.array([self.buckets], pa.list_(pa.string())), "joins": pa.array([self.joins], pa.string())})
        return stored(spark.createDataFrame(row), "rules").select(F.struct("pairs", "joins")).scalar()

    def folded(self, df: DataFrame, column: str, name: str, many: bool = False) -> DataFrame:
        """``df`` with the ids of the pieces in ``column`` (with ``many``, of each of a list's pieces) in its place, as ``name``."""
        def fold(rules: Column) -> Column:
            return F.transform(column, lambda piece: self.fold(rules, piece)) if many else self.fold(rules, F.col(column))

        rest = [c for c in df.columns if c != column]
        return df.withColumn(RULES, self.rules(df.sparkSession)).select(*rest, _bind(F.col(RULES), fold).alias(name))

    def pieces(self, text: Column) -> Column:
        """The pattern's matches, with Unicode classes as tokenizers read them."""
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?U){self.pattern}"), F.lit(0))

    @staticmethod
    def _made(pairs: Column, two: Column) -> Column:
        bucket = F.element_at(pairs, (F.crc32(two.cast("binary")) % BUCKETS).cast("int") + 1)
        return F.substring(bucket, F.instr(bucket, F.concat(F.lit(MARK), two)) + 3, F.lit(1))

    def _step(self, pairs: Column, state: Column) -> Column:
        """Joins the leftmost pair of lowest rank; without such a pair, nothing is left to make."""
        parts, made = state["parts"], state["made"]

        def join(token: Column) -> Column:
            at = F.instr(made, token)      # at least 2, since the first pair holds END
            return F.struct(
                F.concat(F.substring(parts, F.lit(1), at - 1), token, F.substring(parts, at + 2, F.length(parts))).alias("parts"),
                F.concat(F.substring(made, F.lit(1), at - 2), self._made(pairs, F.concat(_char(parts, at - 1), token)),
                         self._made(pairs, F.concat(token, _char(parts, at + 2))), F.substring(made, at + 2, F.length(parts))).alias("made"))

        done = F.struct(parts.alias("parts"), F.lit("").alias("made"))
        return F.when(made == "", state).otherwise(
            _bind(F.array_min(F.split(made, "")), lambda token: F.when(token == NONE, done).otherwise(join(token))))

    def fold(self, rules: Column, piece: Column) -> Column:
        """Ids of one piece that is not empty."""
        def merged(pairs: Column, parts: Column) -> Column:
            places = F.sequence(F.lit(1), F.length(parts) - 1)
            made = F.array_join(F.transform(places, lambda i: self._made(pairs, F.substring(parts, i, F.lit(2)))), "")
            return F.aggregate(
                F.split(parts, ""), F.struct(parts.alias("parts"), made.alias("made")), lambda s, _: self._step(pairs, s),
                lambda s: F.transform(F.split(F.substring(s["parts"], F.lit(2), F.length(s["parts"]) - 2), ""), _rank_of))

        def by_rank(chars: Column) -> Column:
            # cut up only where a long piece is found
            held = F.filter(F.transform(F.split(rules["joins"], LINE), lambda join: F.split(join, MARK)), lambda join: F.contains(chars, F.get(join, F.lit(0))))
            whole = F.aggregate(held, chars, lambda state, join: F.replace(state, F.get(join, F.lit(1)), F.get(join, F.lit(2))))
            return F.transform(F.split(whole, ""), _rank_of)

        chars = F.translate(F.decode(piece.cast("binary"), "ISO-8859-1"), self.bytes, self.singles)
        step_by_step = _bind(rules["pairs"], lambda pairs: _bind(F.concat(F.lit(END), chars, F.lit(END)), lambda parts: merged(pairs, parts)))
        return F.when(F.octet_length(piece) > LONG, _bind(chars, by_rank)).otherwise(step_by_step) if self.in_order else step_by_step

    def word_table(self, df: DataFrame, text: str = "text", words: int = WORDS) -> pa.Table:
        """piece, ids of the most common distinct pieces found more than once; at most ``words`` rows reach the driver."""
        counts = stored(df.select(F.explode(self.pieces(F.col(text))).alias("piece")).groupBy("piece").count()
                        .filter((F.col("count") > 1) & (F.octet_length("piece") <= 64)), "counts")
        # the least count whose words fit, to a tenth of a power of two: at most some hundred rows
        step = F.floor(F.log2(F.col("count").cast("double")) * 10).cast("int")
        least, taken = 0, 0
        for at, n in sorted((r[0], r[1]) for r in counts.groupBy(step.alias("step")).agg(F.count("*")).collect())[::-1]:
            taken += n
            if taken > words:
                least = at + 1
                break
        common = counts.filter(step >= least).select("piece", F.col("piece").alias("folded"))
        spread = common.repartition(df.sparkSession.sparkContext.defaultParallelism * 4, "piece")
        return self.folded(spread, "folded", "ids").toArrow()

    def encode(self, df: DataFrame, text: str = "text", words: int = WORDS, keep: list[str] | None = None,
               then: tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str] | None = None, rows: int = 1000) -> DataFrame:
        """``df``, or its columns ``keep``, with ``ids array<int>``.

        ``then`` is a function of the result's Arrow batches and the schema it gives: what is to be
        derived from the ids in the same Python pass, without sending them to another one. The result is
        stored, so that the word table can be dropped; Arrow batches have at most ``rows`` texts.
        """
        spark = df.sparkSession
        # a batch of the usual 10,000 texts is large for a Python worker
        batch = min(rows, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}):
            known_pieces, known_ids = self._shared(spark, self.word_table(df, text, words))
            pa.default_memory_pool().release_unused()
            done = stored(self._encoded(df, text, keep, then, known_pieces, known_ids), "encoded")
        known_pieces.destroy()
        known_ids.destroy()
        return done

    @staticmethod
    def _shared(spark: SparkSession, table: pa.Table) -> tuple[Broadcast, Broadcast]:
        """The pieces, and bounds and values of their ids, for all tasks; the driver keeps neither."""
        bounds, flat = _list(table["ids"].cast(pa.list_(pa.int32())).combine_chunks())
        ids = bounds.astype(np.int32), flat.astype(np.uint16 if flat.max(initial=0) < 1 << 16 else np.int32)
        return spark.sparkContext.broadcast(table["piece"].cast(pa.string()).combine_chunks()), spark.sparkContext.broadcast(ids)

    def _encoded(self, df: DataFrame, text: str, keep: list[str] | None, then: tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str] | None,
                 known_pieces: Broadcast, known_ids: Broadcast) -> DataFrame:
        names = [c for c in (df.columns if keep is None else keep) if c != "ids"]
        fields = df.select(*names).schema.fields

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of_text, found = _list(batch.column(batch.num_columns - 1), False)
                distinct = found.dictionary_encode()
                # the small side is hashed: where each table row stands among the batch's distinct pieces, if it does
                place = pc.index_in(known_pieces.value, value_set=distinct.dictionary.cast(pa.string()))
                rows = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
                code_of = np.full(len(distinct.dictionary), -1, np.int32)
                code_of[place.drop_null().to_numpy()] = rows
                codes = code_of[distinct.indices.to_numpy()]
                missed = np.flatnonzero(codes < 0)
                of_missed = np.searchsorted(missed, of_text)
                pieces, others, of_others = found.take(pa.array(missed)).to_pylist(), [], [0]
                for i in range(batch.num_rows):
                    new: dict[str, int] = {}
                    at = slice(of_missed[i], of_missed[i + 1])
                    codes[missed[at]] = [~new.setdefault(p, len(new)) for p in pieces[at]]
                    others += new
                    of_others.append(len(others))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), pa.array(codes, pa.int32())),
                     pa.ListArray.from_arrays(pa.array(of_others, pa.int32()), pa.array(others, pa.string()))],
                    names=[*batch.schema.names[:-1], "__codes", "__others"])

        def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bounds, flat = known_ids.value
            starts, sizes = bounds[:-1], np.diff(bounds)
            for batch in _slices(batches):
                of_text, codes = _list(batch.column(batch.num_columns - 2))
                of_others, folded = _list(batch.column(batch.num_columns - 1), False)
                of_piece, own = _list(folded)
                text = np.repeat(np.arange(batch.num_rows), np.diff(of_text))
                known = codes >= 0
                other = of_others[text[~known]] + ~codes[~known]
                n, start = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
                n[known], start[known] = sizes[codes[known]], starts[codes[known]]
                n[~known], start[~known] = np.diff(of_piece)[other], of_piece[other]
                ends = np.concatenate(([0], np.cumsum(n)))
                place = np.arange(ends[-1]) + np.repeat(start - ends[:-1], n)
                from_table = np.repeat(known, n)
                ids = np.empty(len(place), np.int32)
                ids[from_table], ids[~from_table] = flat[place[from_table]], own[place[~from_table]]
                lists = pa.ListArray.from_arrays(pa.array(ends[of_text].astype(np.int32)), pa.array(ids))
                done = pa.RecordBatch.from_arrays([*batch.columns[:-2], lists], names=[*batch.schema.names[:-2], "ids"])
                yield done if then is None else then[0](done)

        step = df.select(*names, self.pieces(F.col(text).cast("string")).alias("__pieces")).mapInArrow(coded, T.StructType(
            [*fields, T.StructField("__codes", T.ArrayType(T.IntegerType())), T.StructField("__others", T.ArrayType(T.StringType()))]))
        step = self.folded(step, "__others", "__folded", many=True)
        whole = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
        return step.mapInArrow(ordered, whole if then is None else then[1])

    def decoder(self) -> Callable[[Iterable[int]], bytes]:
        """A function from ids to bytes: the tokens' binary pieces one after the other."""
        tokens = self.tokens
        return lambda ids: b"".join(map(tokens.__getitem__, ids))

    def decode(self, ids: Column) -> Column:
        """The bytes of an id list."""
        one = self.decoder()

        @F.pandas_udf("binary")
        def joined(lists: pd.Series) -> pd.Series:
            return lists.map(lambda x: one(x.tolist()))

        return joined(ids)
