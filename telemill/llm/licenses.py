"""Licence scans: texts against licence templates by the Dice coefficient of their word bigrams.

A document's units are its whole text, its paragraphs and its lines, and passages that none of these
covers. Units and templates are put into lower case and cut into words of letters and digits; a unit's bigrams are its distinct pairs of words
in a row. With a template of b bigrams, a unit of a bigrams reaches the threshold t only if
a / b lies between t / (2 - t) and (2 - t) / t, so units outside these bounds never meet a template.

The bigrams of the templates, a parameter of checked size, are broadcast; what leaves a task has one
row per unit and template with a common bigram. Only passages are searched for in Python.

A unit that reaches t has at least t / (2 - t) of a template's bigrams. So of any set of more than the
rest of them it has one; the set taken holds the template's longest words. Texts without any such word
are passed over unread.

A passage starts anywhere with a bigram of the template and has from as many to half as many again
words as the template, or the rest of the text. It counts unless it lies in a line, a paragraph or a
text that reaches the threshold for the same licence. Of overlapping passages the best is taken, of
equally good ones of a licence the longest.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import in_bytes, let

THRESHOLD = 0.8
#: Words of all templates together, which bounds what is broadcast.
MAX_TEMPLATE_WORDS = 1_000_000

# Licence notices and short licence texts, as publicly used.
NOTICES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
}
TEXTS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version. This program is distributed
        in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
        License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
        IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
}
GNU = TEXTS["GPL-3.0"]
BSD = (
    """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain
        the above copyright notice, this list of conditions and the following disclaimer. 2.
        Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    """3. Neither the name of the copyright holder nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written
        permission.""",
    """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
        IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
        CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
        THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
)
CREATIVE_COMMONS = {
    "CC-BY-4.0": "Attribution",
    "CC-BY-NC-4.0": "Attribution-NonCommercial",
    "CC-BY-NC-ND-4.0": "Attribution-NonCommercial-NoDerivatives",
    "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike",
    "CC-BY-ND-4.0": "Attribution-NoDerivatives",
    "CC-BY-SA-4.0": "Attribution-ShareAlike",
}
#: Further wordings: other texts, notices by full names, SPDX lines.
WORDINGS = [
    ("AGPL-3.0", GNU.replace("GNU General", "GNU Affero General")),
    ("BSD-2-Clause", f"{BSD[0]} {BSD[2]}"),
    ("BSD-3-Clause", " ".join(BSD)),
    ("GPL-2.0", GNU.replace("version 3", "version 2")),
    ("LGPL-3.0", GNU.replace("GNU General", "GNU Lesser General")),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    ),
    *(
        (name, f"This work is licensed under a Creative Commons {kind} 4.0 International License.")
        for name, kind in CREATIVE_COMMONS.items()
    ),
    *(
        (name, f"{verb} under the {name.replace('-C', ' C')} License.")
        for name in ("BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT")
        for verb in ("Licensed", "Distributed")
    ),
    *(
        (name, f"SPDX-License-Identifier: {name}")
        for name in sorted({*NOTICES, *CREATIVE_COMMONS})
    ),
]
TEMPLATES = [*NOTICES.items(), *TEXTS.items(), *WORDINGS]

STRINGS = "array<string>"
#: What stands between two words.
BETWEEN = r"[^\p{L}\p{N}]+"


def words(text: str) -> list[str]:
    """The words of a template, as `_words` has them for a column."""
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def bigrams(text: str) -> set[str]:
    own = words(text)
    return {f"{a} {b}" for a, b in zip(own, own[1:])}


def telling_words(sets: list[set[str]], threshold: float) -> list[str]:
    """Words of which a unit holds one or more if it reaches the threshold for any template."""
    found: set[str] = set()
    for own in sets:
        left = len(own) - math.ceil(threshold / (2 - threshold) * len(own) - 1e-9) + 1
        own = set(own)
        for word in sorted({w for pair in own for w in pair.split()}, key=lambda w: (-len(w), w)):
            if left <= 0:
                break
            covered = {pair for pair in own if word in pair.split()}
            if covered:
                found.add(word)
                own -= covered
                left -= len(covered)
    return sorted(found)


def _holds_any(text: Column, own: list[str]) -> Column:
    def any_of(lowered: Column) -> Column:
        return reduce(Column.__or__, [F.contains(lowered, F.lit(w)) for w in own], F.lit(False))

    return let(F.lower(text), any_of)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), BETWEEN), lambda w: w != "")


def _units(text: Column) -> Column:
    """The whole text, its paragraphs and its lines, each once."""
    return F.array_distinct(
        F.concat(F.array(text), F.split(text, r"\n[ \t]*\n"), F.split(text, r"\n"))
    )


def _bigrams(own: Column) -> Column:
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(own) - 1),
        lambda i: F.concat(F.get(own, i - 1), F.lit(" "), F.get(own, i)),
    )
    return F.array_distinct(pairs)


@dataclass(frozen=True)
class Template:
    license: str
    length: int
    pairs: frozenset[tuple[str, str]]


def _word_pairs(own: list[str]) -> list[tuple[str, str]]:
    return list(zip(own, own[1:]))


def _starts(at: list[int], pairs: list[tuple[str, str]], most: int, need: int) -> Iterator[int]:
    """The positions of `at` with `need` different pairs at the positions up to `most` further on."""
    inside: Counter[tuple[str, str]] = Counter()
    end = 0
    for start in at:
        while end < len(at) and at[end] < start + most:
            inside[pairs[at[end]]] += 1
            end += 1
        if len(inside) >= need:
            yield start
        inside[pairs[start]] -= 1
        if not inside[pairs[start]]:
            del inside[pairs[start]]


def _best_end(
    pairs: list[tuple[str, str]], start: int, template: Template, most: int
) -> tuple[float, int]:
    """The highest coefficient of a passage from a pair on, and the end of the first with it."""
    last = min(start + most, len(pairs))
    least = min(start + template.length, last)
    seen: set[tuple[str, str]] = set()
    common, best = 0, (0.0, start)
    for i in range(start, last):
        if pairs[i] not in seen:
            seen.add(pairs[i])
            common += pairs[i] in template.pairs
        if i + 1 >= least:
            dice = 2.0 * common / (len(seen) + len(template.pairs))
            if dice > best[0]:
                best = (dice, i + 1)
    return best


class Passages:
    """Finds the passages of texts that reach the threshold and are in no other unit that does."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.templates = []
        self.holders: dict[tuple[str, str], list[int]] = defaultdict(list)
        for license_, text in templates:
            pairs = _word_pairs(words(text))
            if pairs:
                for pair in set(pairs):
                    self.holders[pair].append(len(self.templates))
                self.templates.append(Template(license_, len(pairs), frozenset(pairs)))

    def of(self, text: str) -> list[tuple[str, float, str]]:
        """License, coefficient and words of each passage."""
        lowered = text.lower()
        own = words(lowered)
        pairs = _word_pairs(own)
        hits: dict[int, list[int]] = defaultdict(list)
        for i, pair in enumerate(pairs):
            for k in self.holders.get(pair, ()):
                hits[k].append(i)
        # A text in which every template is met by some common pair only is done with here.
        reaching = []
        for k, at in hits.items():
            template = self.templates[k]
            least = self.threshold / (2 - self.threshold)
            need = math.ceil(least * len(template.pairs) - 1e-9)
            most = math.ceil(template.length / least)
            if len(at) < need:
                continue
            for start in _starts(at, pairs, most, need):
                dice, end = _best_end(pairs, start, template, most)
                if dice >= self.threshold:
                    reaching.append((-dice, template.license, start - end, start))
        if not reaching:
            return []
        spans = [m.span() for m in re.finditer(r"[^\W_]+", lowered)]
        breaks = [m.span() for m in re.finditer(r"\n[ \t]*\n", lowered)]
        taken = bytearray(len(own))
        cached: dict[tuple[int, int], frozenset[tuple[str, str]]] = {}
        found = []
        for less, license_, back, start in sorted(reaching):
            end = start - back
            if any(taken[start : end + 1]):
                continue
            taken[start : end + 1] = b"\1" * (end + 1 - start)
            begin, stop = spans[start][0], spans[end][1]
            units = _units_around(lowered, breaks, begin, stop)
            for unit in units:
                if unit not in cached:
                    cached[unit] = frozenset(_word_pairs(words(lowered[slice(*unit)])))
            if not any(self._reaches(cached[unit], license_) for unit in units):
                found.append((license_, -less, " ".join(own[start : end + 1])))
        return found

    def _reaches(self, pairs: frozenset[tuple[str, str]], license_: str) -> bool:
        return any(
            2.0 * len(pairs & t.pairs) / (len(pairs) + len(t.pairs)) >= self.threshold
            for t in self.templates
            if t.license == license_
        )


def _units_around(
    text: str, breaks: list[tuple[int, int]], begin: int, stop: int
) -> list[tuple[int, int]]:
    """The whole text, and the paragraph and the line that a passage lies in, if it lies in one."""
    units = [(0, len(text))]
    if not any(begin < end and at < stop for at, end in breaks):
        units.append((
            max((end for _, end in breaks if end <= begin), default=0),
            min((at for at, _ in breaks if at >= stop), default=len(text)),
        ))
    if "\n" not in text[begin:stop]:
        after = text.find("\n", stop)
        units.append((text.rfind("\n", 0, begin) + 1, after if after >= 0 else len(text)))
    return units


def _passages(texts: DataFrame, id_type: str, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """id, unit, license and dice of the passages of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = Passages(templates, threshold)
        for batch in batches:
            for part in in_bytes(batch, "text"):
                rows: list[int] = []
                found: list[tuple[str, float, str]] = []
                for row, text in enumerate(part.column("text").to_pylist()):
                    own = passages.of(text)
                    rows += [row] * len(own)
                    found += own
                columns = [
                    part.column("id").take(pa.array(rows, pa.int32())),
                    pa.array([xxhash.xxh64_intdigest(body) >> 1 for _, _, body in found], pa.int64()),
                    pa.array([license_ for license_, _, _ in found], pa.string()),
                    pa.array([dice for _, dice, _ in found], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "unit", "license", "dice"])

    return texts.mapInArrow(run, f"id {id_type}, unit bigint, license string, dice double")


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per id of `docs`: id, license, dice and n_units.

    `license` is the name of the best template (of equally good ones the first by name), `dice` its
    coefficient and `n_units` the number of different units, passages among them, that reach the threshold for any template;
    without one they are null, null and 0. A null, empty or one-word text has none. Rows with the same
    id count as one document with the units of all. An empty table gives no rows. Other columns are
    not read.
    """
    spark = docs.sparkSession
    sets = [(name, bigrams(text)) for name, text in templates]
    if sum(len(own) for _, own in sets) > MAX_TEMPLATE_WORDS:
        raise ValueError("too many templates to broadcast their bigrams")
    # A little wider, as the quotients are rounded.
    low, high = threshold / (2 - threshold) - 1e-9, (2 - threshold) / threshold + 1e-9
    rows = [
        (i, name, len(own), pair) for i, (name, own) in enumerate(sets) for pair in sorted(own)
    ]
    known = spark.createDataFrame(rows, "template int, license string, b int, pair string")
    sizes = [len(own) for _, own in sets if own]
    fewest = min(sizes, default=1) * low
    most = max(sizes, default=0) * high

    telling = telling_words([own for _, own in sets], threshold)

    ids = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # Distinct bigrams are no more than words less one, so most units stop there.
    own = let(
        _words(F.col("unit")),
        lambda w: F.when(F.size(w) - 1 >= fewest, _bigrams(w)).otherwise(F.array().cast(STRINGS)),
    )
    held = ids.filter(F.col("text").isNotNull() & _holds_any(F.col("text"), telling))
    units = (
        held.select("id", F.explode(_units(F.col("text"))).alias("unit"))
        .filter(_holds_any(F.col("unit"), telling))
        # In a generator, a unit's bigrams are made once, whatever is asked of them below.
        .select("id", F.xxhash64("unit").alias("unit"), F.explode(F.array(own)).alias("pairs"))
        .withColumn("a", F.size("pairs"))
        .filter((F.col("a") >= fewest) & (F.col("a") <= most))
    )
    bounded = (F.col("a") >= F.col("b") * low) & (F.col("a") <= F.col("b") * high)
    dice = F.lit(2.0) * F.col("common") / (F.col("a") + F.col("b"))
    alike = (
        units.select("id", "unit", "a", F.explode("pairs").alias("pair"))
        .join(F.broadcast(known), "pair")
        .filter(bounded)
        .groupBy("id", "unit", "a", "template", "license", "b")
        .agg(F.count(F.lit(1)).alias("common"))
        .withColumn("dice", dice)
        .filter(F.col("dice") >= threshold)
    )
    id_type = docs.schema[id_column].dataType.simpleString()
    passages = _passages(held, id_type, templates, threshold)
    reached = alike.select("id", "unit", "license", "dice").unionByName(passages)
    best = reached.groupBy("id").agg(
        F.max("dice").alias("dice"),
        F.min(F.struct((-F.col("dice")).alias("less"), "license")).getField("license").alias("license"),
        F.countDistinct("unit").alias("n_units"),
    )
    return (
        ids.select("id")
        .distinct()
        .alias("d")
        .join(best.alias("m"), F.col("d.id").eqNullSafe(F.col("m.id")), "left")
        .select(
            F.col("d.id").alias(id_column),
            "license",
            "dice",
            F.coalesce("n_units", F.lit(0)).cast("bigint").alias("n_units"),
        )
    )
