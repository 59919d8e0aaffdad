"""Tokenizing by a table of distinct chunks: texts are cut where no token can cross, each distinct
chunk is encoded once, and the ids of a text are joined back by position.

The table lives in a task. A table of all chunks of a corpus would have to move every occurrence of
every chunk twice, some 20 bytes for a word of five.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that a table holds before it starts anew. It bounds memory and changes no result.
TABLE_CHUNKS = 200_000


class ChunkTable:
    """Codes for chunks; `encode` gives what is kept of each new chunk, one list per column."""

    def __init__(self, encode: Callable[[list[str]], list[list]], columns: int):
        self._encode = encode
        self._columns = columns
        self._clear()

    def _clear(self) -> None:
        self._codes: dict[str, int] = {}
        self._kept: list[list] = [[] for _ in range(self._columns)]

    def look_up(self, chunks: pa.StringArray) -> tuple[np.ndarray, list[list]]:
        """For each chunk its place in the returned columns, which have each distinct chunk once."""
        if len(self._codes) > TABLE_CHUNKS:
            self._clear()
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [x for x in distinct if x not in self._codes]
        if new:
            for kept, more in zip(self._kept, self._encode(new), strict=True):
                kept.extend(more)
            self._codes.update(zip(new, range(len(self._codes), len(self._codes) + len(new))))
        at = [self._codes[x] for x in distinct]
        return np.asarray(coded.indices), [[kept[i] for i in at] for kept in self._kept]


def joined_lists(
    places: np.ndarray, lists: list[list[int]], counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The lists at `places` end to end, and where each row ends; row i has counts[i] places."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    table = np.fromiter((x for ids in lists for x in ids), np.int32, int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    taken = sizes[places]
    ends = np.cumsum(taken)
    total = int(ends[-1]) if len(ends) else 0
    inner = np.arange(total, dtype=np.int64) - np.repeat(ends - taken, taken)
    values = table[np.repeat(begins[places], taken) + inner]
    last = np.cumsum(counts)
    return values, np.concatenate([[0], ends])[last]


def split_at_spaces(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Chunks between single spaces, and how many each text has."""
    lists = pc.split_pattern(texts, " ")
    return lists.flatten(), np.asarray(pc.list_value_length(lists), dtype=np.int64)
