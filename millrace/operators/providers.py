"""Model back ends as injectable functions over Arrow batches: embeddings, OCR, images, pair scorers.

A back end is any picklable callable; those whose libraries are absent are loaded only when used. Without a model, embeddings
are zeros."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, IntegerType, StringType, StructField, StructType


def _embeddings(df: DataFrame, id_column: str, value: Column, empty, dim: int, model: Callable[[list], list[list[float]]] | None) -> DataFrame:
    if model is None:
        return df.select(id_column, F.array_repeat(F.lit(0.0).cast("float"), dim).alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = model([empty if x is None else x for x in b.column(1).to_pylist()])
            rows = [(list(v) + [0.0] * dim)[:dim] for v in got]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float32()))], [b.schema.names[0], "embedding"])

    return df.select(id_column, value.alias("_v")).mapInArrow(run, df.select(id_column).schema.add("embedding", ArrayType(FloatType())))


def text_embeddings(df: DataFrame, id_column: str, text: str, dim: int = 384, model: Callable[[list[str]], list[list[float]]] | None = None) -> DataFrame:
    """(id, embedding array<float>), padded or cut to dim; model gets a batch's texts, a null one as empty."""
    return _embeddings(df, id_column, F.col(text).cast("string"), "", dim, model)


def image_embeddings(df: DataFrame, id_column: str, content: str = "content", dim: int = 384, model: Callable[[list[bytes]], list[list[float]]] | None = None) -> DataFrame:
    """(id, embedding array<float>), padded or cut to dim; model gets a batch's image files, a null one as empty. expand_embedding(..., prefix="img_emb_") makes columns."""
    return _embeddings(df, id_column, F.col(content).cast("binary"), b"", dim, model)


def expand_embedding(df: DataFrame, dim: int, prefix: str = "text_emb_", column: str = "embedding") -> DataFrame:
    return df.select(*(c for c in df.columns if c != column), *(F.col(column)[i].alias(f"{prefix}{i}") for i in range(dim)))


def _tesseract(data: bytes) -> str:
    import io

    import pytesseract
    from PIL import Image

    return pytesseract.image_to_string(Image.open(io.BytesIO(data)))


def _paddle(data: bytes) -> str:
    import tempfile

    from paddleocr import PaddleOCR

    with tempfile.NamedTemporaryFile(suffix=".png") as f:
        f.write(data)
        f.flush()
        return "\n".join(line[1][0] for page in PaddleOCR(use_angle_cls=True, show_log=False).ocr(f.name) or [] for line in page or [])


#: Names of OCR back ends; add to it to register one.
OCR: dict[str, Callable[[bytes], str]] = {"tesseract": _tesseract, "paddleocr": _paddle}


def ocr(df: DataFrame, id_column: str, content: str = "content", backend: str | Callable[[bytes], str] = "tesseract") -> DataFrame:
    """(id, text, error): a row that fails has empty text and its error."""
    if isinstance(backend, str):
        if backend not in OCR:
            raise ValueError(f"unknown OCR back end {backend}")
        backend = OCR[backend]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, errors = [], []
            for data in b.column(1).to_pylist():
                try:
                    texts.append(backend(data))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - a row's failure is its result
                    texts.append("")
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts), pa.array(errors, pa.string())], [b.schema.names[0], "text", "error"])

    return df.select(id_column, F.col(content).cast("binary").alias("_c")).mapInArrow(run, df.select(id_column).schema.add("text", StringType()).add("error", StringType()))


def prepare_images(df: DataFrame, id_column: str, content: str = "content", size: int = 224, mean: tuple = (0.485, 0.456, 0.406), std: tuple = (0.229, 0.224, 0.225)) -> DataFrame:
    """(id, valid, width, height, pixels): RGB, scaled into size x size with the aspect kept, padded, normalised. Needs PIL on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        import numpy as np
        from PIL import Image

        for b in batches:
            rows = []
            for data in b.column(1).to_pylist():
                try:
                    im = Image.open(io.BytesIO(data)).convert("RGB")
                except Exception:  # noqa: BLE001 - an unreadable image is a row that isn't valid
                    rows.append((False, None, None, None))
                    continue
                w, h = im.size
                s = size / max(w, h)
                fit = im.resize((max(1, round(w * s)), max(1, round(h * s))), Image.LANCZOS)
                out = Image.new("RGB", (size, size))
                out.paste(fit, ((size - fit.width) // 2, (size - fit.height) // 2))
                rows.append((True, w, h, ((np.asarray(out, np.float32) / 255 - mean) / std).ravel().tolist()))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.bool_(), pa.int32(), pa.int32(), pa.list_(pa.float32())), strict=True))], [b.schema.names[0], "valid", "width", "height", "pixels"])

    return df.select(id_column, F.col(content).cast("binary").alias("_c")).mapInArrow(run, df.select(id_column).schema.add("valid", BooleanType()).add("width", IntegerType()).add("height", IntegerType()).add("pixels", ArrayType(FloatType())))


def score_pairs(df: DataFrame, prompt: str = "prompt", scorer: Callable[[list[str]], list[tuple[float, float]]] | None = None) -> DataFrame:
    """df plus score: softmax of the (yes, no) logits that scorer gives for each prompt; 0.5 without a scorer."""
    if scorer is None:
        return df.withColumn("score", F.lit(0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import math

        for b in batches:
            got = scorer(b.column(b.schema.get_field_index(prompt)).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([1 / (1 + math.exp(max(-700.0, min(700.0, no - yes)))) for yes, no in got], pa.float64())], [*b.schema.names, "score"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("score", DoubleType())]))
