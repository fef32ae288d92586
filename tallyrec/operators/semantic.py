"""Product texts, their vectors, and similarity search over them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.functions.columns import l2_normalize, product_text
from tallyrec.operators.cleaning import remove_duplicates
from tallyrec.operators.nearest import match_lists, top_matches

# Dimensions of a product vector and texts per call of an encoder.
EMBEDDING_DIM = 384
ENCODE_BATCH = 128

# An encoder turns a list of texts into one vector per text.
Encoder = Callable[[Sequence[str]], Sequence[Sequence[float]]]


def product_texts(products: DataFrame) -> DataFrame:
    """(product_id, text): the text that represents each product."""
    parts = [
        F.col(name) if name in products.columns else F.lit(None).cast("string")
        for name in ("title", "description", "product_id")
    ]
    return products.select("product_id", product_text(*parts).alias("text"))


def embed_texts(
    texts: DataFrame,
    load_encoder: Callable[[], Encoder] | None = None,
    batch_size: int = ENCODE_BATCH,
    dim: int = EMBEDDING_DIM,
) -> DataFrame:
    """(product_id, embedding array<float>) with unit vectors, from (product_id, text).

    ``load_encoder`` is called once per task and returns the encoder. Without one, words are
    hashed into ``dim`` counts; that route never leaves the JVM.
    """
    if load_encoder is None:
        return _hashed_words(texts, dim)

    def encode(batches):
        import numpy as np
        import pyarrow as pa

        encoder = load_encoder()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                part = batch.slice(start, batch_size)
                vectors = np.asarray(encoder(part.column("text").to_pylist()), dtype=np.float64)
                nested = pa.FixedSizeListArray.from_arrays(
                    pa.array(vectors.ravel()), vectors.shape[1]
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("product_id"), nested.cast(pa.list_(pa.float64()))],
                    names=["product_id", "vector"],
                )

    raw = texts.select(F.col("product_id").cast("string"), "text").mapInArrow(
        encode, "product_id string, vector array<double>"
    )
    return raw.select(
        "product_id", l2_normalize(F.col("vector")).cast("array<float>").alias("embedding")
    )


def _hashed_words(texts: DataFrame, dim: int) -> DataFrame:
    texts = texts.select(F.col("product_id").cast("string"), "text")
    words = Tokenizer(inputCol="text", outputCol="_words").transform(texts)
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim).transform(words)
    unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0).transform(counts)
    return unit.select("product_id", vector_to_array("_unit", "float32").alias("embedding"))


def embed_products(
    products: DataFrame,
    load_encoder: Callable[[], Encoder] | None = None,
    batch_size: int = ENCODE_BATCH,
) -> DataFrame:
    """Vectors of all products from their title and description."""
    return embed_texts(product_texts(products), load_encoder, batch_size)


def unique_vectors(vectors: DataFrame, order_by: Sequence) -> DataFrame:
    """One vector per product: the first by ``order_by``, which says what came first."""
    return remove_duplicates(vectors, ["product_id"], list(order_by))


class SemanticIndex:
    """Similarity search over (product_id, embedding) with unique ids and unit vectors."""

    def __init__(self, vectors: DataFrame) -> None:
        self.vectors = vectors.select("product_id", F.col("embedding").alias("vector"))

    def similar_products(self, products: DataFrame, top_k: int | str = 10) -> DataFrame:
        """(query_id, product_id, score, rank): the products most similar to each given product.

        ``top_k`` is a number or the name of a column. The product itself is left out; products
        without a vector give no rows.
        """
        return _matches(top_matches(self._asked(products, top_k), self.vectors, exclude_self=True))

    def similar_lists(self, products: DataFrame, top_k: int | str = 10) -> DataFrame:
        """(query_id, low, high, matches): :meth:`similar_products` with a list per row, see
        :func:`tallyrec.operators.nearest.match_lists`."""
        return match_lists(self._asked(products, top_k), self.vectors, exclude_self=True)

    def _asked(self, products: DataFrame, top_k: int | str) -> DataFrame:
        depth = F.col(top_k) if isinstance(top_k, str) else F.lit(top_k)
        wanted = products.groupBy("product_id").agg(F.max(depth).alias("depth"))
        return wanted.join(self.vectors, "product_id").withColumnRenamed("product_id", "query_id")

    def similar_to_vector(self, queries: DataFrame, top_k: int = 10) -> DataFrame:
        """(query_id, product_id, score, rank) for outside unit vectors (query_id, embedding)."""
        queries = queries.select(
            "query_id", F.col("embedding").alias("vector"), F.lit(top_k).alias("depth")
        )
        return _matches(top_matches(queries, self.vectors))


def _matches(found: DataFrame) -> DataFrame:
    return found.select("query_id", "product_id", "score", "rank")
