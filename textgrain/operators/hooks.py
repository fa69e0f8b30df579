"""Places to plug in a text encoder or a token annotator of one's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[Sequence[str]], np.ndarray]
Annotator = Callable[[Sequence[str]], Sequence[tuple[Sequence[str], Sequence[str], Sequence[str]]]]


def encode_texts(
    docs: DataFrame, make_encoder: Callable[[], Encoder], keep: Sequence[str] = (), normalize: bool = True
) -> DataFrame:
    """``(doc_id, keep..., vec)``: one vector per text from a batch encoder.

    ``make_encoder`` runs once per Python worker task, then the encoder gets batches.
    """

    @F.pandas_udf("array<double>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for texts in batches:
            vectors = np.asarray(encoder(texts.fillna("nan").tolist()), dtype=float)
            if normalize and len(vectors):
                length = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                vectors = vectors / length
            yield pd.Series(list(vectors))

    return docs.select("doc_id", *keep, encode("text").alias("vec"))


def annotate_texts(docs: DataFrame, make_annotator: Callable[[], Annotator], keep: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, keep..., text, word, lemma, pos)`` from a batch annotator.

    The annotator returns, per text, the kept words, their lemmas and parts of speech:
    the same columns ``processed_documents`` produces.
    """
    kept = docs.select("doc_id", *keep, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    schema = f"{fields}, word array<string>, lemma array<string>, pos array<string>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        annotator = make_annotator()
        for batch in batches:
            triples = annotator(batch["text"].fillna("nan").tolist())
            words, lemmas, tags = ([list(t[i]) for t in triples] for i in range(3))
            yield batch.assign(
                text=[" ".join(w) for w in words], word=words, lemma=lemmas, pos=tags
            )

    return kept.mapInPandas(run, schema)
