"""Encoding and decoding with a SentencePiece BPE model, by a table of distinct chunks.

The model replaces a space by a marker and puts one marker before a text. If no piece of the model
has a marker after another character, no piece crosses from a word into the marker that follows, so
texts can be cut before each run of markers (this is checked on the model). Each distinct chunk is
segmented once per task by the library; ids and decoded text are joined back by position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.chunks import ChunkTable, joined_lists, split_at_spaces
from telemill.llm.common import in_bytes

MARKER = "▁"
#: Texts whose chunks are not just what stands between spaces.
UNEVEN = f"^ |  | $|^$|{MARKER}"
#: A run of spaces with the word behind it; spaces at the end stay with the last word.
CHUNK = re.compile(" +[^ ]+(?: +\\Z)?| +\\Z")


def crosses(pieces: list[str]) -> bool:
    """Whether a piece has a marker after another character."""
    return any(re.search(f"[^{MARKER}]{MARKER}", piece) for piece in pieces)


def chunks_of(text: str) -> list[str]:
    """The chunks of a text, each without the marker that the library adds to it."""
    spaced = " " + text.replace(MARKER, " ")  # the library takes a literal marker for a space
    return [chunk[1:] for chunk in CHUNK.findall(spaced)] if text else []


def _encoder(model_path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    # The added marker shows on a text of one word; without it chunks could not stand alone.
    if crosses(names) or model.normalize("a b") != f"{MARKER}a{MARKER}b":
        raise ValueError("the pieces of this model cross white space; texts cannot be cut there")

    def encode(chunks: list[str]) -> list[list]:
        ids = model.encode(chunks, num_threads=1)
        return [ids, model.decode(ids)]

    return encode


def encode_decode(
    docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of `docs`: id, ids (array of int) and decoded (the text from these ids).

    A null text counts as empty and has no ids. Repeated rows give repeated rows, an empty table
    none. Other columns are not read. The file must be at the same path on every executor.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(_encoder(model_path), 2)
        for batch in batches:
            for part in in_bytes(batch, "text"):
                # Texts with single spaces only are cut without looking at each character here.
                uneven = pc.match_substring_regex(part.column("text"), UNEVEN)
                yield _encoded(table, part.filter(pc.invert(uneven)), split_at_spaces)
                yield _encoded(table, part.filter(uneven), _split_by_runs)

    return rows.mapInArrow(run, f"id {id_type}, ids array<int>, decoded string").withColumnRenamed(
        "id", id_column
    )


def _split_by_runs(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    lists = [chunks_of(text) for text in texts.to_pylist()]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return pa.array([chunk for chunks in lists for chunk in chunks], pa.string()), counts


def _encoded(table: ChunkTable, part: pa.RecordBatch, split) -> pa.RecordBatch:
    chunks, counts = split(part.column("text"))
    places, (ids, decoded) = table.look_up(chunks)
    values, ends = joined_lists(places, ids, counts)
    words = pa.array(decoded, pa.string()).take(pa.array(places))
    lists = pa.ListArray.from_arrays(_offsets(np.cumsum(counts)), words)
    return pa.RecordBatch.from_arrays(
        [
            part.column("id"),
            pa.ListArray.from_arrays(_offsets(ends), pa.array(values, pa.int32())),
            pc.binary_join(lists, " "),
        ],
        ["id", "ids", "decoded"],
    )


def _offsets(ends: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], ends]), pa.int32())
