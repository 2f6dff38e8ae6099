"""Terms of documents in blocks: an n-gram stands once in a block, and the block's documents refer to it by number.

A block holds whole documents of one group, up to about `BLOCK_GRAMS` n-grams, so what is shuffled to find weights are a block's
distinct n-grams, without the documents. Lists travel compressed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from threadlens.session import written

BLOCK_GRAMS = 1_000_000

#: N-grams that one task compares at a time when documents are counted over all blocks.
BUCKET_GRAMS = 1_500_000


def _packed(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd"), kind)


def _packed_texts(texts: pa.Array) -> tuple[bytes, bytes]:
    """Lengths in bytes, and the bytes."""
    offsets, content = _layout(texts)
    return _packed(np.diff(offsets).astype(np.int32)), _packed(content)


def _unpacked_texts(sizes: bytes, data: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(_unpacked(sizes, np.int32))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(_unpacked(data, np.uint8).tobytes()))


def _layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text starts and ends among the bytes, and the bytes."""
    _, offsets, content = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    content = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], content[offsets[0] : offsets[-1]]


def _bucket_order(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' places in order of their buckets, and how many each bucket has; a text has the same bucket everywhere."""
    offsets, content = _layout(texts)
    sizes = np.diff(offsets)
    power = np.cumprod(np.concatenate([[1], np.full(max(int(sizes.max(initial=0)), 1), 0x100000001B3)]).astype(np.uint64))
    within = np.arange(len(content)) - np.repeat(offsets[:-1], sizes)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((content.astype(np.uint64) + np.uint64(1)) * power[within])])
    mixed = total[offsets[1:]] - total[offsets[:-1]]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    return np.argsort(bucket, kind="stable"), np.bincount(bucket, minlength=buckets)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in runs of about `BLOCK_GRAMS` n-grams; a document is never cut."""
    waiting, held = [], 0
    for batch in batches:
        at, ends = 0, np.cumsum(_lengths(batch.column("grams")))
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = min(int(np.searchsorted(ends, before + BLOCK_GRAMS - held)) + 1, batch.num_rows)
            waiting.append(batch.slice(at, stop - at))
            held += int(ends[stop - 1] - before)
            at = stop
            if held >= BLOCK_GRAMS:
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting, held = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _lengths(grams: pa.Array) -> np.ndarray:
    return grams.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _counted(grams: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams in order, and per document and n-gram: the document's place, the n-gram's number and its count."""
    encoded = grams.flatten().dictionary_encode()
    known = encoded.is_valid().to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(grams)), _lengths(grams))[known]
    code = encoded.indices.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    order = pc.sort_indices(encoded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    width = max(len(order), 1)
    cell, count = np.unique(of * width + rank[code], return_counts=True)
    return encoded.dictionary.take(order), *np.divmod(cell, width), count


def _grams(table: pa.Table) -> pa.Array:
    column = table.column("grams")
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def counted_terms(terms: DataFrame) -> DataFrame:
    """(ngram, tf, df) of `grams` (array of strings), added up within blocks only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            ngrams, _, code, count = _counted(_grams(piece))
            tf = np.bincount(code, count, len(ngrams)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([ngrams, pa.array(tf), pa.array(np.bincount(code, minlength=len(ngrams)))], ["ngram", "tf", "df"])

    return terms.select("grams").mapInArrow(work, "ngram string, tf bigint, df bigint")


def term_blocks(terms: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per block and group of `by`: its documents' `keys`, how many documents, its n-grams with counts, and each
    document's n-grams by number. Documents without n-grams only count in `docs`."""
    kept = terms.select(*keys, "grams")
    fields = [kept.schema[k] for k in keys]
    schema = T.StructType([
        T.StructField("block", T.LongType()), *[kept.schema[c] for c in by], T.StructField("docs", T.LongType()),
        T.StructField("terms", T.LongType()), T.StructField("rows", T.ArrayType(T.StructType(fields))),
        *[T.StructField(c, T.BinaryType()) for c in ("lengths", "spelt", "tfs", "dfs", "sizes", "codes", "counts")],
    ])
    arrow, groups = to_arrow_schema(schema), list(by)

    def block(number: int, group: dict, piece: pa.Table) -> pa.RecordBatch:
        ngrams, of, code, count = _counted(_grams(piece))
        sizes = np.bincount(of, minlength=piece.num_rows)
        own = piece.select([f.name for f in fields]).filter(pa.array(sizes > 0)).combine_chunks()
        entry = arrow.field("rows").type.value_type
        rows = pa.StructArray.from_arrays([own.column(f.name).cast(f.type).combine_chunks() for f in entry], fields=list(entry))
        lengths, spelt = _packed_texts(ngrams)
        one = {
            "block": number, **group, "docs": piece.num_rows, "terms": len(ngrams), "lengths": lengths, "spelt": spelt,
            "tfs": _packed(np.bincount(code, count, len(ngrams)).astype(np.int64)), "dfs": _packed(np.bincount(code, minlength=len(ngrams)).astype(np.int32)),
            "sizes": _packed(sizes[sizes > 0].astype(np.int32)), "codes": _packed(np.diff(code, prepend=0).astype(np.int32)), "counts": _packed(count.astype(np.int32)),
        }
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows).cast(f.type) if f.name == "rows" else pa.array([one[f.name]], f.type)
            for f in arrow
        ], schema=arrow)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for piece in _pieces(batches):
            found: dict[tuple, list[int]] = {}
            for place, group in enumerate(zip(*[piece.column(c).to_pylist() for c in groups])) if groups else ():
                found.setdefault(group, []).append(place)
            for group, places in found.items() if groups else [((), None)]:
                yield block(number, dict(zip(groups, group)), piece if places is None else piece.take(places).combine_chunks())
                number += 1

    return kept.mapInArrow(work, schema)


def block_entries(blocks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per block and n-gram: its number there (`place`), its count and its number of documents."""
    schema = T.StructType([
        T.StructField("block", T.LongType()), *[blocks.schema[c] for c in by], T.StructField("place", T.IntegerType()),
        T.StructField("ngram", T.StringType()), T.StructField("tf", T.LongType()), T.StructField("df", T.LongType()),
    ])
    arrow, same = to_arrow_schema(schema), ["block", *by]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            n = row["terms"]
            own = {
                "place": np.arange(n, dtype=np.int32), "ngram": _unpacked_texts(row["lengths"], row["spelt"]),
                "tf": _unpacked(row["tfs"], np.int64), "df": _unpacked(row["dfs"], np.int32).astype(np.int64),
            }
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]] * n if f.name in same else own[f.name], f.type) for f in arrow], schema=arrow)

    return blocks.select(*same, "terms", "lengths", "spelt", "tfs", "dfs").mapInArrow(work, schema)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def picked_weights(entries: DataFrame) -> DataFrame:
    """(block, idf): the block's `_idf` by `place` as one packed list, not a number where `entries` has no row."""

    def packed(table: pa.Table) -> pa.Table:
        place = table.column("place").to_numpy()
        idf = np.full(int(place.max()) + 1, np.nan)
        idf[place] = table.column("_idf").to_numpy()
        return pa.table({"block": table.column("block").slice(0, 1), "idf": pa.array([_packed(idf)], pa.binary())})

    return entries.select("block", "place", "_idf").groupBy("block").applyInArrow(packed, "block long, idf binary")


def bucket_count(blocks: DataFrame) -> int:
    """Buckets of n-grams that `all_weights` compares one at a time, by the number of n-grams in all blocks."""
    terms = blocks.agg(F.sum("terms")).first()[0] or 0
    return max(int(terms) // BUCKET_GRAMS + 1, blocks.sparkSession.sparkContext.defaultParallelism)


def all_weights(blocks: DataFrame, buckets: int, by: Sequence[str] = ()) -> DataFrame:
    """(block, idf): ln((1+N)/(1+df)) + 1 of all of the block's n-grams, by bucket and there by number, as one packed list.

    N and df are counts of documents, within each group of `by` when given. Equal n-grams of all blocks meet in a bucket; a
    bucket sees an n-gram at most once a block, however many documents have it.
    """
    schema = T.StructType([
        T.StructField("bucket", T.IntegerType()), T.StructField("block", T.LongType()), *[blocks.schema[c] for c in by],
        *[T.StructField(c, T.BinaryType()) for c in ("lengths", "spelt", "dfs")],
    ])
    arrow, same = to_arrow_schema(schema), ["block", *by]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            ngrams, df = _unpacked_texts(row["lengths"], row["spelt"]), _unpacked(row["dfs"], np.int32)
            order, sizes = _bucket_order(ngrams, buckets)
            ngrams, df, ends = ngrams.take(pa.array(order)), df[order], np.cumsum(sizes)
            made = [
                {"bucket": b, "lengths": lengths, "spelt": spelt, "dfs": _packed(df[at:end])}
                for b, (at, end) in enumerate(zip(ends - sizes, ends)) if end > at
                for lengths, spelt in [_packed_texts(ngrams.slice(at, end - at))]
            ]
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name] if f.name in same else m[f.name] for m in made], f.type) for f in arrow], schema=arrow)

    def counted(table: pa.Table) -> pa.Table:
        rows = table.select(["lengths", "spelt", "dfs"]).to_pylist()
        texts, held = [_unpacked_texts(r["lengths"], r["spelt"]) for r in rows], [_unpacked(r["dfs"], np.int32) for r in rows]
        code = pa.concat_arrays(texts).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        df = np.bincount(code, np.concatenate(held)).astype(np.int64)[code]
        parts = np.split(df, np.cumsum([len(h) for h in held])[:-1])
        return table.select(["block", *by, "bucket"]).append_column("dfs", pa.array([_packed(p) for p in parts], pa.binary()))

    def joined(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["bucket", "dfs", "_docs"]).to_pylist(), key=lambda r: r["bucket"])
        df = np.concatenate([_unpacked(r["dfs"], np.int64) for r in rows])
        idf = np.log((rows[0]["_docs"] + 1) / (df + 1)) + 1
        return pa.table({"block": table.column("block").slice(0, 1), "idf": pa.array([_packed(idf)], pa.binary())})

    groups = T.StructType([*[blocks.schema[c] for c in same], T.StructField("bucket", T.IntegerType()), T.StructField("dfs", T.BinaryType())])
    met = blocks.select(*same, "lengths", "spelt", "dfs").mapInArrow(dealt, schema).groupBy(*by, "bucket").applyInArrow(counted, groups)
    if by:
        met = met.join(written(blocks.groupBy(*by).agg(F.sum("docs").alias("_docs")), "docs"), list(by))
    else:
        met = met.withColumn("_docs", F.lit(blocks.agg(F.sum("docs")).first()[0]).cast("bigint"))
    return met.select("block", "bucket", "dfs", "_docs").groupBy("block").applyInArrow(joined, "block long, idf binary")


def weighted_terms(blocks: DataFrame, weights: DataFrame, keys: Sequence[str], buckets: int | None = None, scaled: bool = True) -> DataFrame:
    """One row per document and n-gram that has a weight: `keys`, ngram, tf and count times idf as `weight`, with `scaled`
    brought to length 1 in each document.

    `weights` are by number, or with `buckets` in their order. One row per block meets its packed list, so the join is a
    shuffle join.
    """
    read = blocks.select("block", "rows", "lengths", "spelt", "sizes", "codes", "counts")
    fields = [f for f in blocks.schema["rows"].dataType.elementType if f.name in keys]
    schema = T.StructType([*fields, T.StructField("ngram", T.StringType()), T.StructField("tf", T.LongType()), T.StructField("weight", T.DoubleType())])
    spelled = _spelled(to_arrow_schema(schema), [f.name for f in fields], buckets, scaled)
    return read.join(weights.hint("shuffle_hash"), "block").drop("block").mapInArrow(spelled, schema)


def _spelled(arrow: pa.Schema, names: list[str], buckets: int | None, scaled: bool) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(_each(iter([batch.drop_columns(["rows"])]))):
                ngrams, found = _unpacked_texts(row["lengths"], row["spelt"]), _unpacked(row["idf"], np.float64)
                idf = np.full(len(ngrams), np.nan)
                idf[_bucket_order(ngrams, buckets)[0] if buckets else slice(len(found))] = found
                sizes, step, tf = (_unpacked(row[c], np.int32) for c in ("sizes", "codes", "counts"))
                code = np.cumsum(step, dtype=np.int64)
                raw = tf * idf[code]
                met = ~np.isnan(raw)
                of, code, tf, raw = np.repeat(np.arange(len(sizes)), sizes)[met], code[met], tf[met], raw[met]
                if scaled:
                    raw = raw / np.sqrt(np.bincount(of, raw * raw, len(sizes)))[of]
                rows = batch.column("rows")[i].values.take(pa.array(of))
                columns = [*(rows.field(n) for n in names), ngrams.take(pa.array(code)), pa.array(tf.astype(np.int64)), pa.array(raw)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return work
