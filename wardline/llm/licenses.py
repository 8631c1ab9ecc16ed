"""Operator 5, license scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Texts and templates are lower-cased words without marks, hashed as 5-word shingles. Windows overlap by half: for templates
of ``LONG`` shingles and more a window is two blocks of 8 shingles, with MinHash values of ``BANDS`` x ``ROWS``
permutations; a template's windows are taken at every offset, so a text window that lies within a copy equals one of them
and meets it in every band, and one of Jaccard 0.8 meets it with probability 1 - (1 - 0.8^2)^4 = 0.98, at each of the
template's windows. Shorter templates have windows of one shingle, whose MinHash is the shingle itself, so they are
retrieved whenever one shingle is there. A retrieved template is reported where the text holds at least 0.8 of its distinct
shingles.

The registered query looks for ``COVERED``: the fixed ``TEMPLATES``, which are all that the SQL knows, and ``NOTICES``, the
headers and permission texts of the common families. Beside the templates it reads what five-word shingles cannot hold:
grants by name ("under the MIT License or Apache-2.0", ``NAMES``) and SPDX tags, whose expressions may name any license.
A name without a version (``gpl``) is left out where one of its versions is found.

The catalogue is a parameter of up to ``MAX_SHINGLES`` shingles. Its index travels as constant hash tables, and the plan is
the same for any number of templates; everything is evaluated within the row, and nothing shuffles.

Defined results: null and empty texts have no licenses (count 0, empty string), nor do those below five words, unless they
name one; repeated rows and null ids give a row each; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import SPACE, let, table

#: Shingles of all templates together; the index is a literal of about 100 bytes a shingle.
MAX_SHINGLES = 1 << 18
WORDS, LONG, BLOCK, BANDS, ROWS, PERCENT = 5, 24, 8, 4, 2, 80

#: License notices by name.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "apache-2.0-notice": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
}

_GNU = "under the terms of the GNU {} as published by the Free Software Foundation{} version {} of the License"


def _header(family: str, version: str) -> tuple[str, ...]:
    """Wordings short enough (at most 19 shingles) that another family or version breaks more than a fifth of them."""
    return tuple(_GNU.format(family, either, version) for either in (", either", ";"))


#: Headers and permission texts of the common families; a name may have several wordings.
NOTICES = {
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-2.0-header": _header("General Public License", "2"),
    "gpl-3.0-header": _header("General Public License", "3"),
    "lgpl-2.0-header": _header("Library General Public License", "2"),
    "lgpl-2.1-header": _header("Lesser General Public License", "2.1"),
    "lgpl-3.0-header": _header("Lesser General Public License", "3"),
    "agpl-3.0-header": _header("Affero General Public License", "3"),
    "bsd-conditions": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-3-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "bsd-4-clause": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "zlib-permission": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "bsl-1.0-permission": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") "
        "to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"
    ),
    "cc0-1.0-deed": "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law",
}
COVERED = TEMPLATES | NOTICES

_LICENSE = "licen[cs]e"


def _versions(name: str, title: str, *versions: str) -> dict[str, str]:
    """Patterns of a family: its versions, and its name without one."""
    found = {}
    for v in versions:
        digits = v.replace(".", "") if not v.endswith(".0") else f"{v[:-2]}0?"
        found[f"{name}-{v}"] = f"(?:{title})(?: version| v)?(?: |(?=v?[0-9]))v?{digits}(?:only|orlater)?"
    return found | {name: title}


def _names() -> dict[str, str]:
    """Patterns of names of licenses, over lower-case words without marks."""
    gnu = lambda short, long: f"(?:gnu )?(?:{short}|{long}general public {_LICENSE})(?: {short})?"
    found = {"mit": f"(?:mit|expat)(?: {_LICENSE})?", "isc": f"isc(?: {_LICENSE})?", "zlib": f"zlib(?: {_LICENSE})?", "unlicense": "unlicense", "wtfpl": "wtfpl", "0bsd": "0bsd|zero clause bsd", "cc0-1.0": "(?:cc0|creative commons zero)(?: ?10)?(?: universal)?"}
    for k, word in ((2, "two|simplified|freebsd"), (3, "three|new|revised|modified"), (4, "four|original")):
        found[f"bsd-{k}-clause"] = f"bsd ?{k} ?clause|bsd{k}|(?:{k}|{word}) ?(?:clause )?bsd"
    found["bsd"] = f"bsd(?: style)? {_LICENSE}"
    found |= _versions("apache", f"apache(?: software)?(?: {_LICENSE})?|asl", "1.1", "2.0")
    found |= _versions("gpl", gnu("gpl", "(?<!lesser )(?<!library )(?<!affero )"), "1.0", "2.0", "3.0") | _versions("lgpl", gnu("lgpl", "(?:lesser|library) "), "2.0", "2.1", "3.0") | _versions("agpl", gnu("agpl", "affero "), "1.0", "3.0")
    found |= _versions("mpl", f"mozilla public {_LICENSE}(?: mpl)?|mpl", "1.1", "2.0") | _versions("epl", f"eclipse public {_LICENSE}(?: epl)?|epl", "1.0", "2.0")
    found |= _versions("eupl", f"european union public {_LICENSE}(?: eupl)?|eupl", "1.1", "1.2") | _versions("cddl", f"common development and distribution {_LICENSE}(?: cddl)?|cddl", "1.0", "1.1")
    found |= _versions("bsl", f"boost software {_LICENSE}", "1.0") | _versions("artistic", f"artistic {_LICENSE}", "1.0", "2.0") | _versions("ofl", f"sil open font {_LICENSE}", "1.1")
    parts = {"nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
    for kinds in ((), ("sa",), ("nc",), ("nd",), ("nc", "sa"), ("nc", "nd")):
        short, long = "".join(f" ?{k}" for k in kinds), "".join(f" ?{parts[k]}" for k in kinds)
        title = f"cc ?by{short}|creative commons attribution{long}"
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            found["-".join(("cc-by", *kinds, v))] = f"(?:{title})(?: {_LICENSE})?(?: version)? ?v?{v.replace('.', '')}(?: (?:international|unported|generic))?"
        found["-".join(("cc-by", *kinds))] = title
    return found


NAMES = _names()
_FILL = f"the|a|an|of|both|either|terms|conditions|and|or|andor|dual|{_LICENSE}s?|at|your|option|any|later|version"
_NAMED = f" under(?=((?:(?: (?:{_FILL})(?= ))*+ (?:{'|'.join(f'(?:{p})' for p in NAMES.values())})(?= ))+))"
#: Names of families, left out where a longer name of theirs is found.
FAMILIES = [n for n in NAMES if any(m.startswith(n + "-") for m in NAMES)]
_SPDX = "(?<![A-Za-z0-9])(?i:SPDX-License-Identifier):[(\\x20\\t]*+([A-Za-z0-9][A-Za-z0-9.+-]*+(?:[)\\x20\\t]++(?:OR|AND|WITH)[(\\x20\\t]++[A-Za-z0-9][A-Za-z0-9.+-]*+)*+)"


def tokens(text: Column) -> Column:
    """Lower-case words without marks."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"[^\\p{{L}}\\p{{N}}{SPACE}]+", "")
    return F.array_remove(F.split(plain, f"[{SPACE}]+", -1), "")


def shingles(words: Column) -> Column:
    """Hashes of all 5-word shingles, in order."""
    one = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WORDS)))
    return F.when(F.size(words) < WORDS, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(words) - WORDS), one))


def _seeds() -> list[int]:
    """One mask per permutation: multiples of an odd constant, as signed 64-bit numbers."""
    return [((k + 1) * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63) for k in range(BANDS * ROWS)]


def _bands(minima: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(b), *minima[b * ROWS : (b + 1) * ROWS]) for b in range(BANDS)]


def text_bands(hashes: Column) -> Column:
    """Band keys of all windows of two blocks; the last block may be short."""
    starts = F.sequence(F.lit(1), F.size(hashes), F.lit(BLOCK))
    block = lambda i: let(F.slice(hashes, i, F.lit(BLOCK)), lambda s: F.array(*(F.array_min(F.transform(s, lambda x: x.bitwiseXOR(F.lit(m)))) for m in _seeds())))  # noqa: B023, E731
    window = lambda a, b: F.array(*_bands([F.least(F.get(a, F.lit(k)), F.get(b, F.lit(k))) for k in range(BANDS * ROWS)]))
    pairs = lambda m: F.flatten(F.zip_with(F.slice(m, 1, F.size(m) - 1), F.slice(m, 2, F.size(m) - 1), window))
    return F.when(F.size(hashes) < LONG, F.array().cast("array<bigint>")).otherwise(let(F.transform(starts, block), pairs))


class Index(NamedTuple):
    """Wordings by number: their names and numbers of distinct shingles, and the wordings of each shingle, of each single
    shingle that retrieves a short one, and of each band key that retrieves a long one."""

    names: list[str]
    sizes: list[int]
    shingles: dict[int, list[int]]
    single: dict[int, list[int]]
    bands: dict[int, list[int]]


def _constant(value: list, kind: str) -> Column:
    """A literal of any size as one expression, which the optimiser folds."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def template_index(spark: SparkSession, templates: dict[str, str | tuple[str, ...]]) -> Index:
    """The catalogue as an index; it travels with the plan, so its size is bounded."""
    wordings = [(n, t) for n, held in sorted(templates.items()) for t in ([held] if isinstance(held, str) else held)]
    texts = spark.range(1).select(F.posexplode(_constant([t for _, t in wordings], "array<string>")).alias("i", "t"))
    hashed = {r.i: list(r.h) for r in texts.select("i", let(tokens(F.col("t")), shingles).alias("h")).collect()}
    index = Index([n for n, _ in wordings], [len(set(hashed[i])) for i in range(len(wordings))], {}, {}, {})
    if sum(index.sizes) > MAX_SHINGLES:
        raise ValueError(f"a catalogue holds at most {MAX_SHINGLES} shingles, this one {sum(index.sizes)}")
    for i, h in sorted(hashed.items()):
        for held in [index.shingles] + [index.single] * (len(h) < LONG):
            for x in sorted(set(h)):
                held.setdefault(x, []).append(i)
    long = [{"i": i, "h": h} for i, h in sorted(hashed.items()) if len(h) >= LONG]
    if long:
        every = spark.range(1).select(F.explode(_constant(long, "array<struct<i:int,h:array<bigint>>>")).alias("w")).select("w.*")
        windows = every.select("i", F.explode(F.transform(F.sequence(F.lit(1), F.size("h") - 2 * BLOCK + 1), lambda k: F.slice("h", k, F.lit(2 * BLOCK)))).alias("w"))
        minima = [F.array_min(F.transform("w", lambda x: x.bitwiseXOR(F.lit(m)))) for m in _seeds()]  # noqa: B023
        for r in windows.select("i", F.explode(F.array(*_bands(minima))).alias("k")).distinct().orderBy("i", "k").collect():
            index.bands.setdefault(r.k, []).append(r.i)
    return index


def _lookup(entries: dict[int, list[int]]) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """Whether a number is a key, and the wordings of a key: a hash table of constant lists, so a look-up costs the same for any catalogue."""
    size = 1 << max(1, len(entries)).bit_length()
    held: list[list[dict]] = [[] for _ in range(size)]
    for h, found in entries.items():
        held[h & size - 1].append({"h": h, "t": found})
    keys = _constant([[e["h"] for e in bucket] for bucket in held], "array<array<bigint>>")
    full = _constant(held, "array<array<struct<h:bigint,t:array<int>>>>")
    place = lambda x: x.bitwiseAND(F.lit(size - 1)).cast("int")
    known = lambda x: F.array_contains(F.get(keys, place(x)), x)
    return known, lambda x: F.flatten(F.transform(F.filter(F.get(full, place(x)), lambda e: e["h"] == x), lambda e: e["t"]))


def found(text: Column, index: Index) -> Column:
    """Names of the templates that a text holds, in order."""
    return let(tokens(text), lambda w: held_in(w, index))


def held_in(words: Column, index: Index) -> Column:
    """The same for the words of a text."""
    (is_single, of_single), (is_band, of_band), (is_shingle, of_shingle) = (_lookup(x) for x in (index.single, index.bands, index.shingles))
    names, sizes = _constant(index.names, "array<string>"), _constant(index.sizes, "array<int>")

    def check(h: Column, near: Column) -> Column:
        """Names of the retrieved wordings of whose distinct shingles the text holds enough."""
        own = F.flatten(F.transform(F.array_distinct(F.filter(h, is_shingle)), of_shingle))
        enough = lambda own: F.filter(near, lambda i: F.size(F.filter(own, lambda j: j == i)) * 100 >= PERCENT * F.get(sizes, i))
        return F.array_sort(F.array_distinct(F.transform(let(own, enough), lambda i: F.get(names, i))))

    def scan(h: Column) -> Column:
        near, far = F.filter(h, is_single), F.filter(text_bands(h), is_band)
        hits = lambda one, many: F.array_distinct(F.concat(F.flatten(F.transform(one, of_single)), F.flatten(F.transform(many, of_band))))
        return let(near, lambda one: let(far, lambda many: F.when(F.size(one) + F.size(many) == 0, F.array().cast("array<string>")).otherwise(let(hits(one, many), lambda ids: check(h, ids)))))

    return let(shingles(words), scan)


def named_in(words: Column) -> Column:
    """Names of the licenses that a text grants by name; each grant is a chain of names after "under"."""
    each = lambda c: F.array_compact(F.array(*(F.when(c.rlike(f" (?:{p}) "), F.lit(n)) for n, p in NAMES.items())))
    chains = F.regexp_extract_all(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), F.lit(_NAMED), F.lit(1))
    return F.flatten(F.transform(chains, lambda c: each(F.concat(c, F.lit(" ")))))


def tagged_in(text: Column) -> Column:
    """Licenses of SPDX tags, in lower case; exceptions are no licenses."""
    terms = lambda e: F.split(F.regexp_replace(e, "[()\\x20\\t]++WITH[()\\x20\\t]++[A-Za-z0-9.+-]++", ""), "[()\\x20\\t]++(?:OR|AND)[()\\x20\\t]++", -1)
    every = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_SPDX), F.lit(1)), terms))
    return F.filter(F.transform(every, lambda x: F.lower(F.regexp_replace(x, "\\.+$", ""))), lambda x: ~x.isin("none", "noassertion"))


def covered(text: Column, index: Index) -> Column:
    """Names of all licenses of a text, in order: templates, grants by name and SPDX tags."""
    tags = F.when(text.rlike("(?i)SPDX-License-Identifier:"), tagged_in(text))
    every = let(tokens(text), lambda w: F.concat(held_in(w, index), named_in(w), F.coalesce(tags, F.array().cast("array<string>"))))
    own = lambda a: F.filter(a, lambda x: ~(x.isin(FAMILIES) & F.exists(a, lambda y: y.startswith(F.concat(x, F.lit("-"))))))
    return F.array_sort(F.array_distinct(let(every, own)))


def scan(docs: DataFrame, templates: dict[str, str | tuple[str, ...]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", names: bool = False) -> DataFrame:
    """One row per document: doc_id, n_licenses, licenses (names, comma-joined, in order). ``names``: grants by name and SPDX tags too."""
    index = template_index(docs.sparkSession, templates)
    held = docs.select(F.col(id_col).alias("doc_id"), (covered if names else found)(F.col(text_col), index).alias("_f"))
    return held.select("doc_id", F.size("_f").cast("long").alias("n_licenses"), F.array_join("_f", ",").alias("licenses"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), COVERED, names=True)


def _sql() -> str:
    quoted = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items()))
    words = r"list_filter(string_split_regex(regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}\x20\x09-\x0D]+', '', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    cut = "list_distinct(list_transform(range(1, len({0}) - 3), lambda i: array_to_string({0}[i:i+4], ' ')))"
    return f"""
WITH t AS (SELECT name, {cut.format('w')} AS s FROM (SELECT name, {words.format('t')} AS w FROM (VALUES {quoted}) v(name, t))),
d AS (SELECT doc_id, {cut.format('w')} AS s FROM (SELECT doc_id, {words.format('text')} AS w FROM documents)),
m AS (SELECT doc_id, list(name ORDER BY name) AS names FROM d, t
      WHERE len(d.s) > 0 AND 100 * len(list_intersect(t.s, d.s)) >= {PERCENT} * len(t.s) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(names), 0) AS n_licenses, coalesce(array_to_string(names, ','), '') AS licenses
FROM documents d LEFT JOIN m USING (doc_id)
"""


SQL = _sql()
