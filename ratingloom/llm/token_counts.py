"""Token counts without token ids.

A text is cut into pre-tokens that no piece of the vocabulary spans: a run of spaces with the characters up to the
next space. Pieces are counted once per distinct pre-token of a batch, joined to the frequencies of the documents and
summed. Counts of frequent pre-tokens are kept from batch to batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import textpack as tp
from ratingloom.llm.common import text_frame

REMEMBERED = 300_000  # pre-tokens whose counts a worker keeps
SLICE_BYTES = 2 << 20
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def spans_no_space(pieces: list[str]) -> bool:
    """True if no piece has a space mark after another character, which makes the cut exact."""
    return not any("▁" in p.lstrip("▁") for p in pieces)


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens in order, less the space that the library puts in front, and n + 1 bounds by text.

    A text begins with a space of its own, so a cut falls before each space that follows another character.
    """
    space = data == 0x20
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    first = first[:-1]
    cut = np.zeros(len(data), bool)
    cut[1:] = space[1:] & ~space[:-1]
    cut |= first
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))
    bounds = np.searchsorted(starts, offsets)
    # Behind the first of a text, a cut stands at a space, which the library adds again. A text that begins with
    # other characters takes the added one at its start; one that begins with spaces keeps all of them.
    starts = starts + (~first[starts])
    return tp.strings(data, starts, ends), bounds


def count(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every whole text.

    ``model_file`` is a sentencepiece model, readable on every executor. A null or empty text has no tokens. Rows are
    taken one by one: repeated rows and null ids come back, other columns are ignored, and nothing is shuffled. A
    model with pieces that span a space is refused, as the cut would not be exact.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if not spans_no_space([model.id_to_piece(i) for i in range(model.get_piece_size())]):
            raise ValueError(f"{model_file} has pieces that span a space")
        # What is left of a text's last pre-token if it is one space; the library gives nothing for an empty string.
        known = {"": 1 if model.piece_to_id("▁") != model.unk_id() else 3}
        for batch in batches:
            for lo, hi, data, offsets in tp.slices(batch.column(1), SLICE_BYTES):
                text, bounds = pre_tokens(data, offsets)
                coded = text.dictionary_encode()
                distinct = coded.dictionary.to_pylist()
                fresh = [p for p in distinct if p not in known]
                counts = dict(zip(fresh, map(len, model.encode(fresh, num_threads=1)), strict=True))
                pieces = np.array([known[p] if p in known else counts[p] for p in distinct], np.int64)
                room = REMEMBERED - len(known)
                known.update(list(counts.items())[: max(0, room)])
                total = np.concatenate([[0], np.cumsum(pieces[coded.indices.to_numpy()] if len(pieces) else [])]).astype(np.int64)
                n = total[bounds[1:]] - total[bounds[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets), pa.int64()), pa.array(n, pa.int64()), pc.greater(pa.array(n, pa.int64()), limit)],
                    schema=tp.arrow_schema(SCHEMA),
                )

    return text_frame(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tally, SCHEMA)
