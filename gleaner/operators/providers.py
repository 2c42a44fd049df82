"""Embedding and label providers: models come in as callables; batching, caching, guards and failures are handled here."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import embedding_input, guarded_label, prompt
from gleaner.session import materialize
from gleaner.sources import archives

Embedder = Callable[[list[str]], np.ndarray]
Labeller = Callable[[str], str]


def embed(df: DataFrame, key: str, text: Column, provider: Embedder, batch: int = 32) -> DataFrame:
    """``key, embedding``: unit vectors of the texts, ``batch`` at a time; a NULL text is embedded as ''.

    Zero vectors stay as they are. An empty table gives no rows.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, parts = pdf["text"].fillna("").tolist(), []
            for k in range(0, len(texts), batch):
                x = np.asarray(provider(texts[k : k + batch]), np.float64)
                n = np.linalg.norm(x, axis=1, keepdims=True)
                parts += (x / np.where(n > 0, n, 1)).astype(np.float32).tolist()
            yield pd.DataFrame({key: pdf[key], "embedding": parts})

    return df.select(key, text.alias("text")).mapInPandas(run, f"{key} {kind}, embedding array<float>")


def cached_embeddings(df: DataFrame, key: str, text: Column, provider: Embedder, path: str, model: str) -> DataFrame:
    """``key, embedding`` of all rows from the table at ``path``, which gets the vectors it lacks.

    Vectors are kept by key, model and a hash of the text, so that changed texts and other
    models are embedded anew.
    """
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    kept = archives.read_archive(spark, path, f"{key} {kind}, model string, text_hash bigint, embedding array<float>").where(F.col("model") == model)
    asked = df.select(key, text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    fresh = asked.join(kept.select(key, "text_hash"), [key, "text_hash"], "left_anti")
    new = embed(fresh, key, F.col("text"), provider).join(fresh.select(key, "text_hash"), key)
    new = materialize(new.select(key, F.lit(model).alias("model"), "text_hash", "embedding"), "embedded")
    new.write.mode("append").parquet(path)
    return asked.select(key, "text_hash").join(kept.drop("model").unionByName(new.drop("model")), [key, "text_hash"]).select(key, "embedding")


def article_input(size: int = 300) -> Column:
    """Title and the beginning of the content, as articles are embedded."""
    return embedding_input(F.col("title"), F.col("content"), size)


def label_issues(meta: DataFrame, providers: dict[str, Labeller], name: str, template: str) -> DataFrame:
    """``issue_cluster_id, issue_label, cluster_size, representative_titles`` labelled by the named provider.

    The label is guarded by its length; without titles, without a usable label or where the
    provider fails it is ``issue_<id>``. An unknown provider is a ValueError.
    """
    if name not in providers:
        raise ValueError(f"unknown label provider {name!r}")
    call = providers[name]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for t in texts:
                try:
                    out.append(str(call(t) or "") if t else "")
                except Exception:  # noqa: BLE001  a label that fails is no label
                    out.append("")
            yield pd.Series(out)

    ask = F.when(F.size(F.coalesce("representative_titles", F.array().cast("array<string>"))) > 0, prompt(template, F.col("representative_titles"))).otherwise("")
    got = meta.withColumn("__label", F.pandas_udf(run, "string")(ask))
    bare = guarded_label(F.col("__label"))
    label = F.when(bare != "", bare).otherwise(F.concat(F.lit("issue_"), "issue_cluster_id"))
    return got.select("issue_cluster_id", label.alias("issue_label"), "cluster_size", "representative_titles")
