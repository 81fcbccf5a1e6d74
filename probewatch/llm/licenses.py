"""License scans: MinHash bands over overlapping windows, verified by shingle containment.

DataFrame functions only.  A template is cut into segments of at most ``SEGMENT`` shingles.
A segment of size class c (up to c shingles, c a power of two) is looked up in windows of
2c shingles that overlap by half, so some window holds the whole segment and their Jaccard
similarity is above 1/4.  Each of ``BANDS`` bands is one MinHash; at least one collides with
a probability of 1 - (3/4)^24 > 0.998.  A collision only proposes; a match is a place where
the template's shingles are contained, exactly counted.

A document is cut into pieces of ``PIECE`` shingles, each with the first ones of the next, so
that no row carries a whole text.  A window can collide only if it holds the shingle at which
the segment takes its minimum, so pieces and windows without any shingle of a template are
left out; a Bloom filter whose size follows the templates tells them, and errs only towards
keeping some.  Collisions are pairs of numbers; what they verify is read from the pieces that
the template's stretch touches, and each piece sends only the template's shingles in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probewatch.llm.common import offered, settle

WIDTH, BANDS, SEGMENT = 3, 24, 8
#: Least share of a template's shingles that a match contains.
CONTAINED = 0.8
#: Shingles of a piece, a multiple of ``SEGMENT``, and those that it repeats of the next.
PIECE, HALO = 256, 2 * SEGMENT
#: Bits of the Bloom filter for each template shingle, at least, and the places of a shingle in it.
BITS, PLACES = 64, 3

# Usual license notices.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.")
_BSD_NAMES = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
NOTICES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header":
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    "bsd-2-text": _BSD_TERMS + _BSD_DISCLAIMER,
    "bsd-3": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met",
    "bsd-3-text": _BSD_TERMS + _BSD_NAMES + _BSD_DISCLAIMER,
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-2.0-header":
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header":
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "isc-text":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "lgpl-2.1-header":
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
        "version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for "
        "more details.",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the Software), to deal in the Software without restriction",
    "mit-text":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS,
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# End of the fixed values.


def notices(spark: SparkSession) -> DataFrame:
    """The usual notices as a table (template_id, text)."""
    rows = [F.struct(F.lit(k).alias("template_id"), F.lit(v).alias("text")) for k, v in sorted(NOTICES.items())]
    return spark.range(1).select(F.inline(F.array(*rows)))


def shingles(text: Column) -> Column:
    """Hashes of the shingles of ``WIDTH`` words, in order; none for shorter texts.

    The words are bound to a lambda's variable, so that they are split once per row however
    the optimiser moves the expression.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")

    def hashed(w):
        places = F.when(F.size(w) >= WIDTH, F.sequence(F.lit(0), F.size(w) - WIDTH)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return F.get(F.transform(F.array(words), hashed), 0)


def _bands(shingle_array: Column) -> Column:
    """(band, value) of every band: the least hash of the window's shingles."""
    def band(k):
        least = F.array_min(F.transform(shingle_array, lambda x: F.xxhash64(x, F.lit(k))))
        return F.struct(F.lit(k).alias("band"), least.alias("value"))

    return F.array(*[band(k) for k in range(BANDS)])


def _class(size: Column) -> Column:
    return F.when(size <= 1, 1).when(size <= 2, 2).when(size <= 4, 4).otherwise(SEGMENT)


def _places(x: Column, bits: int) -> list[Column]:
    """The places of a hash in a filter of so many bits, a power of two."""
    return [F.shiftrightunsigned(x, 20 * k).bitwiseAND(F.lit(bits - 1)) for k in range(PLACES)]


def _sieve(known: DataFrame):
    """A test of hashes that all shingles of the templates pass, and few others."""
    hashes = known.select(F.explode("sh").alias("x")).distinct()
    bits = 1 << max(12, (hashes.count() * BITS - 1).bit_length())
    place = hashes.select(F.explode(F.array(*_places(F.col("x"), bits))).alias("p")).select(
        F.shiftright("p", 6).alias("long"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    filled = [0] * (bits // 64)
    for r in place.groupBy("long").agg(F.bit_or("bit").alias("bits")).collect():
        filled[r["long"]] = r["bits"]
    table = F.split(F.lit(",".join(map(str, filled))), ",").cast("array<bigint>")  # folded into one constant

    def passes(x):
        found = None
        for p in _places(x, bits):
            test = F.getbit(F.get(table, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
            found = test if found is None else found & test
        return found

    return passes


def _pieces(text: Column, passes) -> Column:
    """(base, sh) of the pieces that hold a shingle which passes; the shingles are bound to a lambda's variable."""
    def cut(sh):
        bases = F.when(F.size(sh) > 0, F.sequence(F.lit(0), F.size(sh) - 1, F.lit(PIECE))).otherwise(F.array().cast("array<int>"))
        every = F.transform(bases, lambda at: F.struct(at.alias("base"), F.slice(sh, at + 1, F.lit(PIECE + HALO)).alias("sh")))
        return F.filter(every, lambda piece: F.exists(piece["sh"], passes))

    return F.get(F.transform(F.array(shingles(text)), cut), 0)


def scan(docs: DataFrame, templates: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """doc_id, template_id, word (where the template would start), containment, text_hash.

    One row per document row's distinct match place; ``containment`` is the share of the
    template's distinct shingles within the stretch of its length around the window.  Nearby
    windows of one place give one row, the best.  Null, empty and short texts have no match,
    templates of fewer words than a shingle find nothing.  Repeated documents of one id and
    text give their matches once.  Texts may be of any length.  Extra columns are ignored;
    empty tables give no rows.
    """
    known = settle(templates.where("template_id is not null").select("template_id", shingles(F.col("text")).alias("sh")))
    known = known.where(F.size("sh") > 0)
    starts = F.sequence(F.lit(0), F.size("sh") - 1, F.lit(SEGMENT))
    segment = known.select("template_id", F.xxhash64("sh").alias("form"), F.size("sh").alias("length"), "sh", F.explode(starts).alias("from"))
    segment = segment.withColumn("part", F.slice("sh", F.col("from") + 1, F.lit(SEGMENT))).drop("sh")
    keys = segment.select("template_id", "form", "length", "from", _class(F.size("part")).alias("class"), F.explode(_bands(F.col("part"))).alias("e"))
    keys = keys.select("template_id", "form", "length", "from", "class", "e.band", "e.value").distinct()
    sets = known.select("template_id", F.xxhash64("sh").alias("form"), F.array_distinct("sh").alias("set")).distinct()

    passes = _sieve(known)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text",
                       F.monotonically_increasing_id().alias("row"))
    pieces = rows.select("doc_id", "text_hash", "row", F.explode(_pieces(F.col("text"), passes)).alias("piece"))
    pieces = settle(pieces.select("doc_id", "text_hash", "row", "piece.base", "piece.sh"))
    classes = F.array(*[F.lit(c) for c in (1, 2, 4, SEGMENT)])
    windows = pieces.select("row", "base", "sh", F.explode(classes).alias("class"))
    windows = windows.select("*", F.explode(F.sequence(F.lit(0), F.least(F.size("sh"), F.lit(PIECE)) - 1, F.col("class"))).alias("at"))
    windows = windows.select("row", "class", (F.col("base") + F.col("at")).alias("at"), F.slice("sh", F.col("at") + 1, 2 * F.col("class")).alias("window"))
    probes = windows.where(F.exists("window", passes)).select("row", "class", "at", F.explode(_bands(F.col("window"))).alias("e"))
    probes = probes.select("row", "class", "at", "e.band", "e.value")
    met = probes.join(offered(keys, keys.count(), 128), ["class", "band", "value"])
    # the stretch in which the whole template lies if its segment lies in this window
    begin = F.greatest(F.col("at") - F.col("from"), F.lit(0))
    met = met.select("row", "template_id", "form", begin.alias("begin"), (F.col("length") + 2 * F.col("class")).alias("span")).distinct()

    end = F.col("begin") + F.col("span")
    touched = F.sequence(F.floor(F.col("begin") / PIECE), F.floor((end - 1) / PIECE))
    asked = met.select("*", F.explode(touched).alias("number")).withColumn("base", (F.col("number") * PIECE).cast("int"))
    size = sets.agg(F.count(F.lit(1)), F.sum(F.size("set"))).first()
    asked = asked.join(pieces, ["row", "base"]).join(offered(sets, (size[0] or 0) * 4 + (size[1] or 0), 16), ["template_id", "form"])
    low, high = F.greatest(F.col("begin") - F.col("base"), F.lit(0)), F.least(end - F.col("base"), F.lit(PIECE))
    asked = asked.withColumn("part", F.slice("sh", low + 1, high - low))
    asked = asked.select("doc_id", "text_hash", "row", "template_id", "form", "begin", "span", F.size("set").alias("n"), "part",
                         (F.col("base") + low).alias("low"), F.array_intersect("set", "part").alias("held"))
    first = F.col("low") + F.array_min(F.transform("held", lambda x: F.array_position("part", x))) - 1
    asked = asked.where(F.size("held") > 0).withColumn("word", first.cast("long"))
    share = F.size(F.array_distinct(F.flatten(F.collect_list("held")))) / F.col("n")
    hits = asked.groupBy("doc_id", "text_hash", "row", "template_id", "form", "begin", "span", "n").agg(
        share.alias("containment"), F.min("word").alias("word")).where(F.col("containment") >= contained)
    return hits.groupBy("doc_id", "text_hash", "template_id", "word").agg(F.max("containment").alias("containment"))
