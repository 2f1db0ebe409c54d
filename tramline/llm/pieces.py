"""SentencePiece encoding and decoding: distinct sampled segmentations of whole texts with inclusion probabilities, and texts from ids.

The sampler is a Gumbel top-k without replacement over the unigram lattice of the vocabulary's pieces (see piece_lattice), seeded by the row's key: the
same key, text and model give the same samples on any cluster. Vocabulary models are given by path and never trained.

Defined results: null or empty text has the segmentation of the blank that encoding puts in front; a text with fewer than k segmentations gives all of them, each with
log inclusion probability 0; a null key is a key of its own; repeated rows give equal results each; characters without a piece are spelled in bytes, so decoding
gives back every text exactly; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import give_back, ship
from tramline.llm.piece_lattice import Lattices, Vocabulary, sample
from tramline.llm.shingles import U, chunks, mix

SAMPLES = 2
SEED = 20_240_777
#: Texts that are sampled together, about: the working arrays take some 100 bytes for each byte of text. Results don't depend on it.
TEXT_BYTES = 1 << 18
SCHEMA = "doc_id long, sample int, ids array<int>, n_pieces int, log_prob double, value double, log_inclusion double, round_trip boolean"

_known: dict[int, Lattices] = {}


def lattices_of(model: bytes) -> Lattices:
    """One set of lattices a worker process and model; its size is bounded."""
    if hash(model) not in _known:
        _known[hash(model)] = Lattices(Vocabulary(model))
    return _known[hash(model)]


def spelled_alike(v: Vocabulary, ids: list[np.ndarray], texts: list[bytes]) -> list[bool]:
    """Whether the pieces of each row spell its text again, after the blank in front."""
    every = np.concatenate(ids)
    spelled = v.bytes_of_all(every).tobytes()
    sizes = np.concatenate([[0], np.cumsum(v.n_bytes[every])])[np.cumsum([0, *map(len, ids)])].tolist()
    return [spelled[a + 1 : b] == t for a, b, t in zip(sizes, sizes[1:], texts, strict=False)]


def encoded(batches: Iterator[pa.RecordBatch], model: bytes, samples: int = SAMPLES, seed: int = SEED) -> Iterator[pa.RecordBatch]:
    """The rows of encode() for batches of (id, text)."""
    lattices = lattices_of(model)
    for batch in batches:
        keys = batch.column(0).to_pylist()
        at = 0
        for part in chunks(batch.column(1).cast(pa.binary()).to_pylist(), TEXT_BYTES):
            own = keys[at : at + len(part)]
            at += len(part)
            seeds = mix(np.array([(0 if k is None else k * 2 + 1) & (2**64 - 1) for k in own], U) ^ U(seed))
            drawn = sample(lattices, [t.decode() for t in part], seeds, samples)
            rows = [(k, j + 1, *r, t) for k, t, found in zip(own, part, drawn, strict=True) for j, r in enumerate(found or [(np.zeros(0, np.int32), 0.0, 0.0, 0.0)])]
            ids = [r[2] for r in rows]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            back = spelled_alike(lattices.v, ids, [r[-1] for r in rows])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))), pa.array(np.diff(offsets)),
                    *(pa.array([r[k] for r in rows], pa.float64()) for k in (3, 4, 5)), pa.array(back),
                ],
                names=["doc_id", "sample", "ids", "n_pieces", "log_prob", "value", "log_inclusion", "round_trip"],
            )
    lattices.clear()  # an idle worker holds the vocabulary only; common units are soon built again
    give_back()


def encode(docs: DataFrame, model_path: str, samples: int = SAMPLES, seed: int = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and sample: sample counts from 1 in falling order of the perturbed value."""
    ship(docs.sparkSession)
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded(batches, model.value, samples, seed)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Adds the text of an array of ids; null ids give null."""
    ship(encoded.sparkSession)
    with open(model_path, "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = lattices_of(model.value).v
        for batch in batches:
            yield batch.map(lambda x: None if x is None else v.decode(list(x)))

    return encoded.withColumn(out, text_of(F.col(ids)))
