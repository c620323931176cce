"""License scan: canonical digests of entire texts, joined to the digests of known license texts."""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# License texts and notices as their authors publish them.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "notice-CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "notice-GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "notice-Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "notice-MIT": "Released under the MIT License.",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: title lines that stand before texts without one
TITLES = {"MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"), "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
          "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"), "Zlib": ("zlib License", "The zlib License", "The zlib/libpng License"),
          "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License"),
          "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "BSD License", "New BSD License"),
          "Unlicense": ("The Unlicense", "Unlicense")}
#: whole texts in ``license_texts``, and how many lines of each are its title
FILES = {"Apache-2.0": 3, "BSD-2-Clause": 0, "BSD-3-Clause": 0, "CC0-1.0": 2, "GPL-2.0": 2, "GPL-3.0": 2, "LGPL-2.1": 2, "LGPL-3.0": 2, "MPL-2.0": 1, "Unlicense": 0}
#: other published wordings of the same license: (license, pattern, replacement)
WORDINGS = (("ISC", "and/or distribute", "and distribute"), ("BSD-2-Clause", r"(?m)^ *[0-9]\. ", "* "), ("BSD-3-Clause", r"(?m)^ *[0-9]\. ", "* "),
            ("GPL-2.0", "51 Franklin Street, Fifth Floor, Boston, MA +02110-1301 +USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA"),
            ("LGPL-2.1", "51 Franklin Street, Fifth Floor, Boston, MA +02110-1301 +USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA"),
            ("Unlicense", "http://unlicense.org/?", "https://unlicense.org"))
#: what follows this line tells how to use the license
END = "END OF TERMS AND CONDITIONS"


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: a line that names the owner or reserves rights, after comment signs; the words "copyright notice" or "copyright holders" at the start
#: of a line name nobody
OWNED = (rf"(^|\n)[ \t/*#;%!<>|-]*({_any_case('copyright')}[ \t:]*(\([Cc]\)|©|[0-9]{{4}}|[\[{{<])|\([Cc]\)[ \t]*([0-9]{{4}}|{_any_case('copyright')})|©|"
         rf"{_any_case('all rights reserved')})[^\n]*")
#: white space and signs other than line feeds, of which a run counts as one space
SIGNS = ("".join(chr(i) for r in ((0x00, 0x09), (0x0B, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)) for i in range(r[0], r[1] + 1))
         + "\u00a0\u201c\u201d\u2018\u2019\u2013\u2014\u2026\u00a9\u00ae\u2122")
SPELLINGS = (("licenc", "licens"), ("favour", "favor"), ("behaviour", "behavior"), ("organis", "organiz"), ("authoris", "authoriz"),
             ("recognis", "recogniz"), ("acknowledgement", "acknowledgment"), ("judgement", "judgment"), ("whilst", "while"),
             ("per cent", "percent"), ("copyright holder", "copyright owner"), ("https", "http"))


def canonical_lines(text: Column) -> Column:
    """Without owner lines, lower case, signs as single spaces, one spelling; line feeds stay. Letters and signs are
    exchanged in one walk over the characters, so the expressions only meet what is longer than one space."""
    x = F.regexp_replace(F.coalesce(text, F.lit("")), OWNED, "\n")
    x = F.translate(x, UPPER + SIGNS, LOWER + " " * len(SIGNS))
    x = F.regexp_replace(x, " {2,}", " ")
    for old, new in SPELLINGS:
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def canonical(lines: Column) -> Column:
    """The canonical form of an entire text from its ``canonical_lines``; spellings of two words may have stood on two lines."""
    x = F.trim(F.regexp_replace(F.translate(lines, "\n", " "), " {2,}", " "))
    for old, new in SPELLINGS:
        if " " in old:
            x = F.replace(x, F.lit(old), F.lit(new))
    return x


def canonical_text(text: str) -> str:
    """:func:`canonical` in plain Python, for the SQL and the tests."""
    x = re.sub(OWNED, "\n", text).translate(str.maketrans(UPPER + SIGNS, LOWER + " " * len(SIGNS)))
    for old, new in SPELLINGS if (x := re.sub(" {2,}", " ", x)) else ():
        x = x.replace(old, new)
    x = re.sub("[ \n]+", " ", x).strip(" ")
    for old, new in SPELLINGS:
        x = x.replace(old, new) if " " in old else x
    return x


def published() -> list[tuple[str, str]]:
    """Names and texts: ``KNOWN`` and the files, each with and without its title, what follows the terms, and in other wordings."""
    folder = resources.files(__package__) / "license_texts"
    files = {n: (folder / f"{n}.txt").read_text(encoding="utf-8") for n in FILES}
    out = set()
    for name, text in [*KNOWN.items(), *files.items()]:
        texts = {text} | {re.sub(old, new, text) for n, old, new in WORDINGS if n == name}
        if END in text:
            texts |= {t[:t.index(END) + at] for t in texts for at in (0, len(END))}
        for t in texts:
            lines = [x for x in t.split("\n") if x.strip()]
            out |= {(name, t), (name, "\n".join(lines[FILES.get(name, 0):]))} | {(name, f"{title}\n{t}") for title in TITLES.get(name, ())}
    return sorted(out)


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(published(), "license_id string, text string")


def digests(known: DataFrame) -> DataFrame:
    """``digest, n_canonical, license_id`` of license texts; equal canonical texts count as the one with the smallest name."""
    texts = known.where("text is not null").select("license_id", canonical(canonical_lines(F.col("text"))).alias("c")).where("c <> ''")
    return texts.groupBy(F.sha2("c", 256).alias("digest"), F.length("c").alias("n_canonical")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame | None = None, key: str = "doc_id", text: str = "text", literal_rows: int = 1000, broadcast_rows: int = 100_000) -> DataFrame:
    """One row per document: ``key``, long ``n_canonical`` (length of the canonical text), its ``digest``, ``license_id``
    (null: no known license), long ``n_notices`` and ``notices``: lines that are in their entirety a known text.

    Nothing but equal canonical digests counts as a match. Texts are made canonical once. A line is only hashed if its length
    is that of a known text, which leaves out no match. Up to ``literal_rows`` texts of ``known`` (license_id, text) become a
    map of digests in the plan, so nothing is joined or shuffled; more are joined by digest with the documents and with
    their lines of such lengths, broadcast up to ``broadcast_rows`` rows of 64 characters, otherwise with both sides shuffled.

    Null and empty texts have the empty canonical text, which is no license; null keys and repeated rows stay rows of
    their own; an empty table gives an empty result. Other columns are not read.
    """
    names = digests((known_texts(docs.sparkSession) if known is None else known).select("license_id", "text"))
    names, _ = table(names)
    count = names.count()
    lines = docs.select(F.col(key).alias("key"), canonical_lines(F.col(text)).alias("lines"))
    rows = lines.select("key", "lines", canonical(F.col("lines")).alias("whole"))
    length = F.length("whole").cast("long").alias("n_canonical")
    each = F.transform(F.split("lines", "\n"), lambda x: F.trim(x))
    if count <= literal_rows:
        found = names.collect()
        lengths = sorted({r.n_canonical for r in found})
        license_of = F.create_map(*[F.lit(x) for r in found for x in (r.digest, r.license_id)]) if found else F.lit(None).cast("map<string,string>")
        rows = rows.select("key", length, F.sha2("whole", 256).alias("digest"), F.filter(each, lambda x: F.length(x).isin(lengths)).alias("near"))
        hits = F.filter(F.transform("near", lambda x: F.try_element_at(license_of, F.sha2(x, 256))), lambda x: x.isNotNull())
        rows = rows.select("key", "n_canonical", "digest", F.try_element_at(license_of, F.col("digest")).alias("license_id"), hits.alias("hits"))
    else:
        few = count <= broadcast_rows
        # one number for each length that a known text has
        lengths = [r.n_canonical for r in names.select("n_canonical").distinct().collect()]
        rows, _ = table(rows.select("key", length, F.sha2("whole", 256).alias("digest"), F.monotonically_increasing_id().alias("row"),
                                    F.transform(F.filter(each, lambda x: F.length(x).isin(lengths)), lambda x: F.sha2(x, 256)).alias("near")))
        names = names.select("digest", "license_id")
        names = F.broadcast(names) if few else names
        lines = rows.select("row", F.explode("near").alias("digest")).join(names, "digest").groupBy("row").agg(F.collect_list("license_id").alias("hits"))
        rows = rows.drop("near").join(names, "digest", "left").join(lines, "row", "left")
    notices = F.when(F.size("hits") > 0, F.array_join(F.sort_array(F.array_distinct("hits")), ","))
    return rows.select(F.col("key").alias(key), "n_canonical", "digest", "license_id", F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_notices"), notices.alias("notices"))
