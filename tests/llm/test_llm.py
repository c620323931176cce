"""Corpus operators against brute force on small fixtures: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import inspect
import pathlib
import random
import re
import textwrap
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lookout.llm import ann, common, embedding, langid, licenses, mixing, minhash, packing, pii, quality, suffix
from lookout.llm import queries as Q
from lookout.llm.components import components
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, digest string, size long, _key string, score string"
TOKENIZER = Q.tokenizer_path()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def prose(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta river stone light water under over seven maple quiet north".split()) + str(rng.randint(0, 400)) for _ in range(n))


def texts():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    near = [b.replace("1", "one", 1) for b in base[:20]]
    shared = prose(rng, 60)
    odd = [None, "", " \t\n", "x", "one two", "Ünï 😀 x@y.org, +1 (555) 010-9999 10.0.0.256 10.0.0.25 4111 1111 1111 1111.", "a" * 3000, "7" * 5000,
           "a@b.c_d@e.f.g", "1.2.3.4.5.6.7.8", "+1234567 +12345678 +1 2", "la la la " * 300, prose(rng, 4000)]
    return base + near + base[:5] + odd + [prose(rng, 5) + " " + shared + " " + prose(rng, 9) for _ in range(6)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "c"][i % 4], "d", i, "k", "s") for i, t in enumerate(texts())]
    rows += [rows[3], rows[3], (None, "null key text with some words", "en", None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_sql(spark, con, name):
    df = Q.QUERIES[name](spark, SF)
    cur = con.execute(Q.ORACLE[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


def brute_suffix(rows, n=200):
    raw = [t.encode() for _, t in rows]
    seen = {}
    for i, r in enumerate(raw):
        for p in range(len(r) - n + 1):
            seen.setdefault(r[p:p + n], []).append((i, p))
    gone = [np.zeros(len(r), bool) for r in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p:p + n] = True
    out = []
    for (k, _), r, g in zip(rows, raw, gone):
        spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if len(g) else 0
        out.append((k, len(r), int(g.sum()), spans, hashlib.sha256(np.frombuffer(r, np.uint8)[~g].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [suffix.HOT, 1])
def test_suffix(docs, empty, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", hot)
    assert sorted((tuple(r) for r in suffix.deduplicated(docs).collect()), key=str) == brute_suffix(plain(docs))
    assert suffix.deduplicated(empty).count() == 0


def test_multikey_sorts():
    rng = np.random.default_rng(2)
    m = rng.integers(0, 3, (400, 5)).astype(np.uint64)
    got = m[suffix.multikey(m)]
    assert (got == m[np.lexsort(m.T[::-1])]).all()


def brute_pii(text):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def valid(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            return 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
        return kind != "phone" or 8 <= len(d) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in kinds.items() for m in re.finditer(p, text) if valid(k, m.group())]


def test_pii_base(spark, docs, empty):
    want = sorted(((k, ",".join(brute_pii(t))) for k, t in plain(docs)), key=str)
    got = pii.personal_data(docs)
    assert sorted(((r.doc_id, r.base_sha256) for r in got.collect()), key=str) == sorted(((k, hashlib.sha256(b.encode()).hexdigest()) for k, b in want), key=str)
    assert pii.personal_data(empty).count() == 0 and pii.sanitised(empty).count() == 0
    rng = random.Random(3)
    parts = ["a", "@", "b.c", ".", "-", "_", "+", "1", "23", "256", " ", "(", "4111111111111111", "é", "😀", "\n", "x@y.z"]
    mixed = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(mixed)), "doc_id long, text string")
    for r in pii.personal_data(rows).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(brute_pii(mixed[r.doc_id])).encode()).hexdigest(), mixed[r.doc_id]


def brute_terms(rows, threshold=0.9, specific=0.5, support=2):
    """Spans of disclosing terms by the definition, over all pairs of entity and term."""
    held, words, bare = [], [], []
    for _, t in rows:
        base = [(b.split(":")[0], int(b.split(":")[1]), int(b.split(":")[2])) for b in brute_pii(t)]
        held.append({(k, t[i:j].lower()) for k, i, j in base})
        inside = [any(i <= p < j for _, i, j in base) for p in range(len(t))]
        open_ = "".join(" " if x else c for c, x in zip(t, inside))
        bare.append([(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W_]+", open_)])
        words.append({m.group().lower() for m in re.finditer(r"[^\W_]+", t)})
    out = []
    for i, (key, _) in enumerate(rows):
        terms = set()
        for e in held[i]:
            with_e = [j for j in range(len(rows)) if e in held[j]]
            for w in {x[2] for x in bare[i]}:
                both = [j for j in with_e if any(x[2] == w for x in bare[j])]
                with_w = sum(w in ws for ws in words)
                if len({rows[j][1] for j in both}) < support or len(with_e) == len(rows):
                    continue
                info = np.log2(len(rows) / len(with_e))
                mutual = np.log2(len(both) * len(rows) / (with_w * len(with_e)))
                if mutual >= threshold * info - 1e-12 and len(both) >= specific * with_w:
                    terms.add(w)
        out.append((key, ",".join([*brute_pii(rows[i][1]), *(f"term:{a}:{b}" for a, b, w in bare[i] if w in terms)])))
    return sorted(out, key=str)


def letters(rng):
    """Notes that name people far from their addresses, in a template that all of them share."""
    out = []
    for who, mail, n in (("Zebediah", "zeb@corp.org", 5), ("Ada 4711", "ada@b.net", 3), ("Xi", "+1 (555) 010-9999", 4), ("Solo", "solo@one.org", 1), ("Twin", "twin@two.org", 1)):
        out += [f"Dear {who}, {prose(rng, 25)} please write to {mail} today. Yours {who.split()[0].upper()}" for _ in range(n)]
    out += [out[-1]] * 3  # copies of one text
    out += [f"Dear reader, {prose(rng, 12)} please do not write today" for _ in range(20)]
    return out + [None, "", "write 4711"]


def test_pii_terms_equal_brute_force(spark):
    rows = list(enumerate(letters(random.Random(8))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = pii.personal_data(df).collect()
    assert sorted(((r.doc_id, r.spans) for r in got), key=str) == brute_terms([(k, t or "") for k, t in rows])
    shuffled = pii.personal_data(df, broadcast_rows=0)
    assert sorted(tuple(r) for r in shuffled.collect()) == sorted(tuple(r) for r in got)


def test_pii_terms_and_replacement(spark):
    rows = list(enumerate(letters(random.Random(8))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    new = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    # the name goes though it stands far from the address, and filler stays
    assert new[0].startswith("Dear [TERM], ") and new[0].endswith(" please write to [EMAIL] today. Yours [TERM]")
    assert new[5].startswith("Dear [TERM] ") and new[8].endswith(" please write to [PHONE] today. Yours [TERM]")
    # one text, or copies of one, do not tell which words belong to the address
    assert new[12].startswith("Dear Solo, ") and new[13].startswith("Dear Twin, ") and new[14] == new[13]
    assert all(new[k] == t for k, t in rows if k >= 17)


def test_quality(spark, docs, empty):
    d, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.scored(d, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == r.quality for r in got if r.held_out]) >= 0.9
    good = quality.accepted(d, labels)
    assert good.columns == d.columns and good.count() == quality.scored(d, labels).where("predicted = 1").count()
    y = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (999, 1)], "doc_id long, quality int")
    out = quality.scored(docs, y).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert quality.scored(empty, y).count() == 0 and quality.scored(docs, y.limit(0)).count() == docs.count()


def vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    rows = [(i, v.tolist(), i % 3, i) for i, v in enumerate(np.vstack([base, base[:20] + 0.05 * rng.normal(size=(20, 16)), base[:20] + 0.15 * rng.normal(size=(20, 16))]))]
    rows += [(200, None, 1, 0), (201, [0.0] * 16, 1, 0), (202, [1.0, None] * 8, 1, 0), (203, [float("nan")] * 16, 1, 0), (204, rows[3][1], None, 0),
             (205, [1.0, 2.0], 0, 0), (206, rows[3][1], 0, 0), (206, rows[3][1], 0, 0), (207, [float("inf")] * 16, 1, 0), (208, [], 1, 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, row long")


@pytest.mark.parametrize("block", [embedding.BLOCK, 7])
def test_embedding(spark, block, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", block)
    rows, df = vectors(spark)
    usable = [r for r in rows if r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1]) and r[2] is not None]
    links, parent = {id(r): 0 for r in rows}, {id(r): id(r) for r in rows}
    groups = [{i} for i in range(len(usable))]
    for i, a in enumerate(usable):
        for j, b in enumerate(usable):
            if i != j and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links[id(a)] += 1
                    if groups[i] is not groups[j]:
                        merged = groups[i] | groups[j]
                        for k in merged:
                            groups[k] = merged
    least = {id(u): min(usable[k][0] for k in groups[i]) for i, u in enumerate(usable)}
    want = sorted((r[0], links[id(r)], least.get(id(r), r[0]), r[0] == least.get(id(r), r[0])) for r in rows)
    assert sorted(tuple(r) for r in embedding.near_duplicates(df).collect()) == want
    assert embedding.near_duplicates(df.limit(0)).count() == 0


def test_error_bound():
    rng = np.random.default_rng(1)
    q = embedding.Quantised(rng.normal(size=(50, 12)))
    a, b = q.may_reach(q, 0.3)
    pairs = set(zip(a.tolist(), b.tolist()))
    s = q.unit @ q.unit.T
    assert all((i, j) in pairs for i, j in zip(*np.nonzero(s >= 0.3)))


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    got = packing.packed(docs, TOKENIZER, length=64, segments=5, open_bins=3).collect()
    whole = {}
    for k, text in plain(docs):
        whole.setdefault(k, []).append([*t.encode(text, add_special_tokens=False).ids, 1])
    assert sum(r.length for r in got) == sum(len(x) for v in whole.values() for x in v)
    for r in got:
        assert any(x[r.start:r.start + r.length] == list(r.ids) and r.doc_tokens == len(x) for x in whole[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        pieces.sort()
        total = sum(n for _, n in pieces)
        assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces[:-1]]).tolist()
        assert total == 64 or total & (total - 1) == 0 and total < 64
        assert len(pieces) <= 5
    assert packing.packed(empty, TOKENIZER).count() == 0


def test_packing_loss_limit():
    packer, done = packing.Packer(length=32, segments=8, loss=10, most=2), []
    rng = random.Random(1)
    for i in range(60):
        n = rng.randint(1, 70)
        done += packer.add(packing.Piece(i, np.arange(n, dtype="<u4"), 0, n, rng.randint(0, n)))
    done += packer.finish()
    for s in done:
        assert sum(map(len, s)) <= 32 and len(s) <= 8 and sum(p.bearing() for p in s) <= 10


def test_words_equal_tokenizer():
    words, rng = packing.Words(TOKENIZER), random.Random(1)
    parts = ["a", "É", "ß", "İ", "Σ", "'s", "'", "1", "23", "!", "..", "<|endoftext|>", "<", "\x1c", "\xa0", "́", "한", "日本", "½", "_", " ", "\x85", " ", "\n", "I'M", "😀"]
    for _ in range(800):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert list(next(iter(words.ids([text])))) == words.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_license(spark, docs, empty):
    mit = licenses.KNOWN["MIT"]
    rows = [(1, "Copyright (c) 2020 Me\n" + mit), (2, mit.upper().replace(",", " ;").replace("\n", "  ")), (3, mit + " more"), (4, None), (5, ""),
            (6, "words\nReleased under the MIT Licence!\nmore"), (None, mit)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k].license_id for k in (1, 2, 3, 4, 5, 6, None)] == ["MIT", "MIT", None, None, None, None, "MIT"]
    assert (got[6].n_notices, got[6].notices) == (1, "notice-MIT")
    assert licenses.scan(docs).count() == docs.count() and licenses.scan(empty).count() == 0


def test_license_in_both_languages(spark):
    """The SQL and a join by digest give what the scan gives, also where older wordings of it parted."""
    rng = random.Random(6)
    isc = licenses.KNOWN["ISC"]
    rows = [(1, "copyright notice and this permission notice appear in all copies.\nReleased under the MIT License."), (2, "one per\ncent of it"), (3, "one per cent\n  Licensed under CC BY-NC 4.0  "),
            (4, "/* Copyright (C) 2020 Me */\n" + isc), (5, "COPYRIGHT: 2019 X\n(c) copyright\n\u00a9 Y\nAll Rights Reserved. And so on\n" + isc.replace("and/or", "and / or")), (6, None), (7, ""),
            (8, " Released under the MIT LICENCE!!\nreleased under the mit license"), (8, "Released under the MIT License."), (None, "kopyright \u00a9 2000 here"), (9, "\u017f all rights re\u017ferved\nx")]
    parts = ["copyright", "Copyright", " (c) ", "\u00a9", "2020", "\n", "\n", " ", "  ", "\t", "#", "*", "notice", "holder", "all rights reserved", "per cent", "per", "cent", "licence", "Favour", "x", "\u201c", "\u00e9", ".", "Released under the MIT License."]
    rows += [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cur = con.execute(Q.ORACLE["op6_license"])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    for limit in (1000, 0):
        for few in (100_000, 0):
            got = licenses.scan(df, literal_rows=limit, broadcast_rows=few)
            assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == want
    first = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert first[1].notices == "notice-MIT" and first[1].n_canonical == 95 and first[4].license_id == "ISC" and first[3].notices == "notice-CC-BY-NC-4.0"
    for key, text in rows[:60]:
        if key not in (8, None):
            assert first[key].digest == hashlib.sha256(licenses.canonical_text(text or "").encode()).hexdigest()


def test_license_as_published(spark):
    def wrapped(text, width, sign=""):
        parts = [textwrap.fill(p, width, break_on_hyphens=False, break_long_words=False) for p in re.split(r"\n\s*\n", text)]
        return "\n".join((sign + line).rstrip() for line in "\n\n".join(parts).split("\n"))

    folder = pathlib.Path(licenses.__file__).parent / "license_texts"
    files = {n: (folder / f"{n}.txt").read_text() for n in licenses.FILES}
    bodies = {n: licenses.KNOWN[n] for n in ("MIT", "ISC", "0BSD", "Zlib")} | {n: files[n] for n in ("BSD-2-Clause", "BSD-3-Clause", "Unlicense")}
    isc = """ISC License

Copyright (c) 2011-2022, Someone <a@b.c>

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

""" + wrapped(licenses.KNOWN["ISC"][licenses.KNOWN["ISC"].index("THE SOFTWARE IS"):], 72)
    want = [(n, t) for n, t in files.items()] + [("ISC", isc), ("Apache-2.0", files["Apache-2.0"].split(licenses.END)[0])]
    want += [(n, title + "\n\nCopyright 2020 Me. All rights reserved.\n\n" + wrapped(t, 70)) for n, t in bodies.items() for title in licenses.TITLES[n]]
    want += [(n, wrapped(t, width, sign)) for n, t in bodies.items() for width in range(40, 90, 3) for sign in ("", " * ", "# ")]
    mit = licenses.KNOWN["MIT"].replace("COPYRIGHT HOLDERS", "\nCOPYRIGHT\nHOLDERS")
    want += [("MIT", "/*\n * Copyright (c) 2020 Me\n * All rights reserved.\n */\n" + mit)]
    want += [(None, files["Apache-2.0"] + "\nand more"), (None, licenses.KNOWN["MIT"] + "\ncopyright notice"), (None, "MIT License")]
    rows = [(i, t) for i, (_, t) in enumerate(want)]
    got = {r.doc_id: r.license_id for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    wrong = [(want[i][0], got[i], want[i][1][:80]) for i in range(len(want)) if got[i] != want[i][0]]
    assert not wrong, (len(wrong), wrong[:5])


def test_language(spark, docs, empty):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identified(d).join(d.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang == r.lang_pred for r in got if r.held_out]) >= 0.95
    out = langid.identified(docs).collect()
    assert len(out) == docs.count()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in dict(plain(docs))[r.doc_id])) for r in out)
    assert langid.identified(empty).count() == 0 and langid.identified(docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0


def test_every_language_is_learned_and_equal_keys_do_not_matter(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("".join(rng.choice([chr(0x4E00 + 4 * (i % 130) + j) for j in range(4)]) for _ in range(3)) for _ in range(20)), f"l{i % 130}") for i in range(130 * 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.identified(df).select("lang_pred").distinct().count() > 100
    many = [(7, prose(rng, 20), "a") for _ in range(40)] + [(i, prose(rng, 20).upper() + "\u00df\u00e9", "b") for i in range(40)]
    df = spark.createDataFrame(many, "doc_id long, text string, lang string")
    runs = [sorted(map(tuple, langid.identified(d, sample_per_language=5).collect()), key=str) for d in (df.repartition(1), df.orderBy(F.desc("text")).repartition(3))]
    assert runs[0] == runs[1]


def test_leader_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(40, 6, replace=False)), rng.random(6), int(rng.integers(0, 3))) for _ in range(10)]
    model = langid.Ftrl(3, alpha=0.4, beta=0.9, l1=0.02, l2=0.05)
    z, n = {}, {}

    def weight(f, c):
        zz, nn = z.get((f, c), 0.0), n.get((f, c), 0.0)
        return 0.0 if abs(zz) <= 0.02 else -(zz - (1 if zz > 0 else -1) * 0.02) / ((0.9 + nn ** 0.5) / 0.4 + 0.05)

    for f, v, y in rows * 3:
        scores = [sum(weight(i, c) * x for i, x in zip(f.tolist(), v.tolist())) for c in range(3)]
        e = [np.exp(s - max(scores)) for s in scores]
        old = {(i, c): weight(i, c) for i in f.tolist() for c in range(3)}
        for c in range(3):
            for i, x in zip(f.tolist(), v.tolist()):
                g = x * (e[c] / sum(e) - (c == y))
                sigma = ((n.get((i, c), 0.0) + g * g) ** 0.5 - n.get((i, c), 0.0) ** 0.5) / 0.4
                z[i, c] = z.get((i, c), 0.0) + g - sigma * old[i, c]
                n[i, c] = n.get((i, c), 0.0) + g * g
        model.learn(f, v, y)
    want = np.array([[weight(i, c) for c in range(3)] for i in range(40)])
    assert np.allclose(model.weights(slice(0, 40)), want, rtol=1e-9, atol=1e-12) and np.any(want)


def test_quality_equals_a_plain_discriminant(spark):
    """Scores from the definition: class moments of the labelled rows outside the fold, shrunk, by solve and determinant."""
    d, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: (r.text or "").encode() for r in d.collect()}
    marks = {r.doc_id: r.quality for r in labels.collect() if r.quality in (0, 1)}
    x = {k: quality.statistics(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for k, t in texts.items()}
    learn = [k for k in texts if k in marks and zlib.crc32(str(k).encode()) % 5]
    everything = np.array([x[k] for k in learn])
    centre, scale = everything.mean(0), everything.std(0)
    scale[scale < 1e-6] = 1.0
    z = {k: (v - centre) / scale for k, v in x.items()}
    density = {}
    for c in (0, 1):
        mine = np.array([z[k] for k in learn if marks[k] == c])
        cov = np.cov(mine.T, bias=True)
        k = len(cov)
        cov = 0.7 * cov + 0.3 * (0.5 * np.diag(np.diag(cov)) + 0.5 * np.trace(cov) / k * np.eye(k)) + 1e-3 * np.eye(k)
        prior = np.log((len(mine) + 1) / (len(learn) + 2))
        density[c] = {i: prior - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (v - mine.mean(0)) @ np.linalg.solve(cov, v - mine.mean(0)) for i, v in z.items()}
    for r in quality.scored(d, labels).collect():
        assert abs(r.score - 1 / (1 + np.exp(-np.clip(density[1][r.doc_id] - density[0][r.doc_id], -35, 35)))) < 1e-6


def test_another_vocabulary_encodes_whole_texts(spark, tmp_path):
    import json

    letters_ = sorted(set("HeloWrdNASA helo"))
    vocab = {t: i for i, t in enumerate([*letters_, *(c + "</w>" for c in letters_ if c != " "), "He", "lo</w>"])}
    said = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "Whitespace"}, "post_processor": None, "decoder": None,
            "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False,
                      "ignore_merges": False, "vocab": vocab, "merges": [["H", "e"], ["l", "o</w>"]]}}
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(said))
    words, texts_ = packing.Words(str(path)), ["Hello World NASA", "hello", "", "NASA Hello"]
    want = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts_]
    assert not words.by_words and [i.tolist() for i in words.ids(texts_)] == want
    import pyarrow as pa

    ids, ends = words.of_column(pa.array([*texts_, None]))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [*want, []]
    docs = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    pieces = sorted((r.doc_id, r.start, list(r.ids)) for r in packing.packed(docs, str(path)).collect())
    assert [sum((x for k, _, x in pieces if k == i), []) for i in range(4)] == [[*w, 1] for w in want]


def test_pipeline_takes_odd_rows(spark, tmp_path):
    import corpus_pipeline as P

    d = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, "null key " + prose(random.Random(1), 40), "en", "web", 9), (10**6, None, "en", "web", None), (10**6 + 1, "", None, None, 0), (10**6 + 2, " \t\n", "en", "web", 3),
           (10**6 + 3, "x" * 50_000, "en", "web", 1), (10**6 + 4, prose(random.Random(2), 30_000), "de", None, 1), (10**6 + 5, "mail me@you.org", "en", "q", 1), (10**6 + 5, "mail me@you.org", "en", "q", 1)]
    rows = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    wide = d.select(rows.columns).unionByName(rows).withColumn("key", F.lit("k")).withColumn("digest", F.lit(1)).withColumn("score", F.lit("s")).withColumn("_text", F.lit(None).cast("string"))
    for name, docs in (("odd", wide), ("none", wide.limit(0))):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        labels = spark.read.parquet(f"{SF}/labels.parquet")
        labels.unionByName(spark.createDataFrame([(None, 1, 0), (10**6 + 4, None, None)], labels.schema)).write.parquet(f"{folder}/labels.parquet")
        step = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in P.STAGES[:-1]:
            before = step.count()
            step = spark.createDataFrame(stage(spark, step, folder).collect(), wide.schema)
            assert step.columns == wide.columns and (before or not step.count())
        out = P.run(spark, folder).collect()
        assert bool(out) == (name == "odd") and all(0 < r.length <= 2048 for r in out)
        sums = {}
        for r in out:
            sums[r.sequence_id] = sums.get(r.sequence_id, 0) + r.length
        assert all(n == 2048 or n & (n - 1) == 0 for n in sums.values())


def test_mixing(docs, empty):
    got = mixing.queue(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.taken <= 2 * r.size for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    total = sum(r.size for r in got)
    assert abs(sum(v[0].target for v in by.values()) - 1.5 * total) < 1e-6 * total
    for v in by.values():
        assert v[0].source_size == sum(r.size for r in v) and sum(r.taken for r in v) == int(v[0].target) and v[0].target <= 2 * v[0].source_size + 1e-9
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and sum(words(r.text) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.queue(empty).count() == 0 and mixing.mixed(empty).count() == 0


@pytest.mark.parametrize("words,turns", [(4, 4), (5, 0)])
def test_minhash(docs, empty, words, turns, monkeypatch):
    monkeypatch.setattr(minhash, "TURNS", turns)  # 0: all pairs in tiles at once
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    rows, sets = plain(docs), []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(low))
        sets.append(frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else []))
    groups = [{i} for i in range(len(rows))]
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and groups[i] is not groups[j]:
                merged = groups[i] | groups[j]
                for k in merged:
                    groups[k] = merged
    want = []
    for i, (k, _) in enumerate(rows):
        keys = [rows[g][0] for g in groups[i] if rows[g][0] is not None]
        least = min(keys) if keys else None
        want.append((k, len(sets[i]), least, k == least))
    got = minhash.near_duplicates(docs, words=words)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    kept = minhash.deduplicated(docs, words=words)
    full = [g for i, g in enumerate(groups) if sets[i]]
    assert kept.columns == docs.columns and kept.count() == len({frozenset(g) for g in full}) + sum(not s for s in sets)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.deduplicated(empty).count() == 0


def test_nearest(spark):
    rows, df = vectors(spark)
    usable = [r for r in rows if r[1] and len(r[1]) == 16 and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    got = {}
    for r in ann.nearest(df, k=7, every=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {r[0] for r in usable if r[0] % 20 == 0}
    for q in usable:
        if q[0] % 20 == 0:
            want = sorted((-float(np.dot(q[1], c[1])), c[0]) for c in usable if c[0] != q[0])[:7]
            mine = sorted(got[q[0]])
            assert [m[1] for m in mine] == [w[1] for w in want] and np.allclose([m[2] for m in mine], [-w[0] for w in want], rtol=0, atol=1e-12)
    assert ann.nearest(df.limit(0)).count() == 0
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in e.collect()}
    ids, m = np.array(list(x)), np.array(list(x.values()))
    hit = n = 0
    found = {}
    for r in ann.nearest(e, leaf_rows=32).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for q, v in found.items():
        s = m @ x[q]
        s[ids == q] = -9
        hit += len(v & set(ids[np.argsort(-s)[:20]].tolist()))
        n += 20
    assert hit / n >= 0.9


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 460)] + [(None, 1), (5, 5)]
    root = {}
    for a, b in edges:
        if a is not None and a != b:
            root.setdefault(a, {a}), root.setdefault(b, {b})
            merged = root[a] | root[b]
            for k in merged:
                root[k] = merged
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: min(v) for k, v in root.items()}


def test_components_of_few_edges_take_no_rounds(spark, monkeypatch):
    from lookout.llm import components as C

    written, real = [], C.table
    monkeypatch.setattr(C, "table", lambda *a, **k: written.append(1) or real(*a, **k))
    chain = spark.range(3000).repartition(4).selectExpr("encode(lpad(id, 5, '0'), 'utf-8') a", "encode(lpad(id + 1, 5, '0'), 'utf-8') b")
    got = C.components(chain).collect()
    assert len(got) == 3001 and {bytes(r.root) for r in got} == {b"00000"} and len(written) == 2
    monkeypatch.setattr(C, "TOGETHER", 1)  # of the driver: what tasks leave goes through rounds
    assert sorted(C.components(chain).collect()) == sorted(got) and len(written) > 4


def test_stars_of_chunks(monkeypatch):
    from lookout.llm import components as C

    monkeypatch.setattr(C, "TOGETHER", 4)
    edges = [(b"d", b"\xff"), (b"c", b"d"), (b"b", b"b2"), (b"c", b"d"), (b"d", b"a"), (b"z", b"y")]
    batches = [pa.RecordBatch.from_pydict({"a": pa.array([e[0]], pa.binary()), "b": pa.array([e[1]], pa.binary())}) for e in edges]
    got = [list(zip(x.column("a").to_pylist(), x.column("b").to_pylist())) for x in C._stars(iter(batches))]
    assert got == [[(b"b2", b"b"), (b"d", b"c"), (b"\xff", b"c")], [(b"d", b"a"), (b"z", b"y")]]
    assert list(C._stars(iter(()))) == []


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]
    step = docs
    for _, stage in P.STAGES[:-1]:
        step = stage(spark, step, SF)
        assert step.columns == docs.columns
        step = spark.createDataFrame(step.collect(), docs.schema)
    out = P.pack_sequences(spark, step, SF)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert P.run(spark, SF).agg(F.sum("length")).first()[0] == out.agg(F.sum("length")).first()[0]


def test_tree_of_equal_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 8))
    copies = rng.choice(3000, 1000, replace=False)
    x[copies] = x[copies[0]]
    tree = ann.Tree(x, 78)  # without a final leaf for the copies it never ended
    leaf = tree.assign(x)
    assert 64 <= tree.leaves <= 78 and len(set(leaf[copies])) == 1 and np.bincount(leaf).max() < 1100
    assert ann.Tree(np.ones((100, 8)), 78).leaves == 1


def test_nearest_among_small_leaves(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1200, 8)) * 0.1
    x[:, 0] += 5
    x[::40] = -np.eye(8)[1] * 50 + rng.normal(size=(30, 8))  # 30 outliers, alone in their leaves
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(0, [float(c) for c in x[0]])] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    counts = {}
    for r in ann.nearest(df, k=40, leaf_rows=16, recall=0.05).select("query_id").collect():
        counts[r.query_id] = counts.get(r.query_id, 0) + 1
    assert set(counts) == set(range(0, 1200, 20)) and all(n == (160 if q == 0 else 40) for q, n in counts.items()), counts


def test_nearest_with_long_vectors_and_many_copies(spark, monkeypatch):
    """A few very long vectors, a third of equal ones and many queries of one leaf leave the results as brute force gives them."""
    monkeypatch.setattr(ann, "ASKED", 8)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 8))
    x[::3] = x[0]
    x[[7, 20, 41]] *= 1e9
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    found = {}
    for r in ann.nearest(df, k=6, every=5, leaf_rows=32, recall=1.0, apart=2).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    right = 0
    for q in range(0, 900, 5):
        s = np.einsum("j,ij->i", x[q], x)
        want = [int(i) for i in np.lexsort((np.arange(900), -s)) if i != q][:6]
        got = sorted(found[q])
        assert [g[0] for g in got] == [1, 2, 3, 4, 5, 6]
        assert all(np.isclose(g[2], s[g[1]], rtol=1e-12) for g in got)
        right += len(set(want) & {g[1] for g in got})
    assert len(found) == 180 and right >= 0.99 * 180 * 6


def test_a_worker_gives_memory_back(monkeypatch):
    """Spark keeps its Python workers; what a step has freed must not count for the executor in later steps."""
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    step = common.frugal(lambda batches: (b.slice(1) for b in batches))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3])], ["x"])
    assert [b.num_rows for b in step(iter([batch, batch]))] == [2, 2] and calls == [1]
    for module in (quality, minhash, packing):
        text = inspect.getsource(module)
        assert text.count("mapInArrow(") == len(re.findall(r"mapInArrow\(\s*frugal\(", text))
