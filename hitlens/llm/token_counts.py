"""Token counts of documents of any length, by overlap resynchronisation.

A long document is cut into parts; every part is encoded with some of the next
one behind it, with offsets, and neighbouring encodings are spliced at a border
that both have and that is proven stable: no piece of the vocabulary holds the
two characters around it, so no merge ever crosses it and what lies behind it
is encoded alike whatever comes before. Where an overlap has no such border,
the document's parts and overlaps are widened until it has, at last to the
whole document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.llm.common import BATCH_BYTES, bounded_batches, stored

TOKENIZER = "piece_bpe_32k.model"
#: Characters of a part, those of the next part encoded with it, and the factor by which both are widened.
PART, OVERLAP, WIDEN = 1 << 15, 512, 8
LIMIT = 4096
SPACE = "▁"


class PieceBpe:
    """A BPE model that reads text as it is (no normalisation but spaces to one sign)."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        kinds = (m.is_control, m.is_unknown, m.is_byte)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not any(kind(i) for kind in kinds)]
        #: Pairs of characters inside pieces: a border between other characters is stable.
        self.joined = {pair for p in pieces for pair in zip(p, p[1:])}

    def count(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))

    def borders(self, text: str) -> tuple[int, list[tuple[int, int]]]:
        """Tokens of ``text``, and (byte offset, tokens before it) of every token that begins at a character."""
        at = [p.begin for p in self.model.encode(text, return_type="proto", num_threads=1).pieces]
        return len(at), [(x, i) for i, x in enumerate(at) if i == 0 or at[i - 1] != x]

    def stable(self, text: str, start: int, end: int) -> list[int]:
        """Places in [start, end) of ``text`` (from 1) with a stable border in front."""
        shown = text[start - 1 : end].replace(" ", SPACE)
        return [start + i for i, pair in enumerate(zip(shown, shown[1:])) if pair not in self.joined]


@lru_cache(maxsize=2)
def piece_bpe(path: str) -> PieceBpe:
    return PieceBpe(path)


def splices(bpe: PieceBpe, text: str, base: int, overlap: int) -> tuple[int, list, list]:
    """Tokens of a unit's ``text``, and its possible splices with the units before and after it.

    ``text`` is ``base`` characters of the unit's own and up to ``overlap`` of
    the next. A splice is (characters from the border of the two units, tokens
    of ``text`` before it). A document's end is a border too.
    """
    total, found = bpe.borders(text)
    tokens = dict(found)

    def common(start: int, end: int) -> list[tuple[int, int]]:
        out, at, seen = [], len(text[:start].encode()), start
        for place in bpe.stable(text, start + 1, end):
            at, seen = at + len(text[seen:place].encode()), place
            if at in tokens:
                out.append((place - start, tokens[at]))
        return out + [(len(text) - start, total)] * (len(text) - start < overlap)

    return total, common(0, min(overlap, len(text))), common(base, len(text)) if len(text) > base else []


_CUTS = pa.list_(pa.struct([("place", pa.int64()), ("tokens", pa.int64())]))
_UNIT = "uid long, unit long, base long, tokens long, head array<struct<place:long,tokens:long>>, tail array<struct<place:long,tokens:long>>"


def _first_pass(path: str, part: int, overlap: int):
    """Documents (key, text) to rows: short ones counted, long ones in parts with the next part's head behind."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(path)
        for batch in batches:
            of, rows, load = [], [], 0

            def out() -> pa.RecordBatch:
                columns = list(zip(*rows, strict=True)) or [()] * 4
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                arrays = [c.take(pa.array(of, pa.int64())) for c in batch.columns[1:]]
                arrays += [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                return pa.RecordBatch.from_arrays(arrays, ["uid", "key", "n_bytes", "n_tokens", "unit", "slice"])

            for i, text in enumerate(batch.column(0).to_pylist()):
                text = text or ""
                size = len(text.encode())
                if len(text) <= part + overlap:
                    of.append(i)
                    rows.append((size, bpe.count(text), None, None))
                    continue
                for unit, start in enumerate(range(0, len(text), part)):
                    of.append(i)
                    rows.append((size, None, unit, text[start : start + part + overlap]))
                    load += part
                    if load > BATCH_BYTES:
                        yield out()
                        of, rows, load = [], [], 0
            yield out()

    return cut


def _encoded(path: str):
    """Units (uid, unit, base, text: ``base`` characters of its own and the overlap) to tokens and splices of head and tail."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(path)
        for batch in batches:
            uids, units, bases, texts, overlaps = (c.to_pylist() for c in batch.columns)
            rows = []
            for base, text, overlap in zip(bases, texts, overlaps, strict=True):
                rows.append(splices(bpe, text, base, overlap))
            totals, heads, tails = list(zip(*rows, strict=True)) or [()] * 3
            as_cuts = lambda lists: pa.array([[{"place": p, "tokens": t} for p, t in x] for x in lists], _CUTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(totals, pa.int64()), as_cuts(heads), as_cuts(tails)],
                ["uid", "unit", "base", "tokens", "head", "tail"])

    return encode


def _spliced(units: DataFrame) -> DataFrame:
    """(uid, n_tokens, failed) per document from its encoded units.

    A unit's tokens count from its splice with the unit before to its splice
    with the next; both sides take the first common border.
    """
    left = units.select("uid", "unit", "tail")
    right = units.select("uid", (F.col("unit") - 1).alias("unit"), "head")
    common = F.expr("filter(tail, x -> exists(head, y -> y.place = x.place))")
    seam = left.join(right, ["uid", "unit"]).withColumn("a", F.get(common, 0))
    seam = seam.withColumn("b", F.get(F.expr("filter(head, y -> y.place = a.place)"), 0))
    seams = seam.groupBy("uid").agg(
        F.sum("a.tokens").alias("ends"), F.sum("b.tokens").alias("starts"), F.max(F.col("a").isNull()).alias("failed"))
    last = units.groupBy("uid").agg(F.max_by("tokens", "unit").alias("last"))
    return last.join(seams, "uid", "left").select(
        "uid", (F.coalesce("ends", F.lit(0)) + F.col("last") - F.coalesce("starts", F.lit(0))).alias("n_tokens"),
        F.coalesce("failed", F.lit(False)).alias("failed"))


def _widened(slices: DataFrame, part: int, factor: int, overlap: int) -> DataFrame:
    """Units of ``factor`` first parts each, with ``overlap`` characters of the next unit."""
    own = slices.select("uid", F.expr(f"unit DIV {factor}").alias("wide"), "unit", F.left("slice", F.lit(part)).alias("own"))
    whole = own.groupBy("uid", "wide").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("unit", "own"))), lambda x: x["own"])).alias("own"))
    ahead = whole.select("uid", (F.col("wide") - 1).alias("wide"), F.left("own", F.lit(overlap)).alias("ahead"))
    return whole.join(ahead, ["uid", "wide"], "left").select(
        "uid", F.col("wide").alias("unit"), F.char_length("own").cast("long").alias("base"),
        F.concat("own", F.coalesce("ahead", F.lit(""))).alias("text"), F.lit(overlap).alias("overlap"))


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
                 part: int = PART, overlap: int = OVERLAP) -> DataFrame:
    """(key, n_bytes, n_tokens) per row of ``docs``.

    A null text is empty and has no tokens. Repeated rows and equal or null
    keys are counted row by row; other columns, whatever their names, don't
    matter. Texts of any length are counted whole: parts are dealt over all
    tasks, and only a text without any stable border ends as one unit. An
    empty table gives an empty one.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    path = tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(text).cast("string"), F.monotonically_increasing_id().alias("uid"), F.col(key).alias("key"))
    first = stored(rows.mapInArrow(_first_pass(path, part, overlap), f"uid long, key {kind}, n_bytes long, n_tokens long, unit long, slice string"), "token-parts")
    short = first.where("unit IS NULL").select("key", "n_bytes", "n_tokens")
    slices = first.where("unit IS NOT NULL").select("uid", "unit", "slice")
    units = slices.select("uid", "unit", F.least(F.lit(part), F.char_length("slice")).cast("long").alias("base"), F.col("slice").alias("text"), F.lit(overlap).alias("overlap"))
    counted, factor = [], 1
    while True:
        dealt = units.repartition("uid", "unit")
        done = stored(_spliced(stored(dealt.mapInArrow(_encoded(path), _UNIT), "token-units")), "token-splices")
        counted.append(done.where("NOT failed").select("uid", "n_tokens"))
        failed = done.where("failed").select("uid")
        if failed.isEmpty():
            break
        factor *= WIDEN
        overlap *= WIDEN
        units = _widened(slices.join(failed, "uid", "left_semi"), part, factor, overlap)
    found = counted[0]
    for more in counted[1:]:
        found = found.union(more)
    long = first.where("unit = 0").select("uid", "key", "n_bytes").join(found, "uid").select("key", "n_bytes", "n_tokens")
    return short.union(long)


def count_digest(docs: DataFrame) -> DataFrame:
    return token_counts(docs).select(F.col("key").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
