from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import oracle
import pyarrow as pa

from tidemark.llm import audit, catalog

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, term string, n int, value int, item string, docs int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, s, "t", 1, 2, "i", 3) for i, (t, g, s) in enumerate(rows)], DOCS)


def plain(rows, documents=30, top=50):
    """All shares of all kept terms, by Python integers."""
    rows = [(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), g or "", s or "") for t, g, s in rows]
    out = set()
    for lang in {g for _, g, _ in rows}:
        mine = [(w, s) for w, g, s in rows if g == lang]
        held = Counter(t for w, _ in mine for t in set(w))
        kept = sorted((t for t in held if held[t] >= documents), key=str.encode)
        counts = defaultdict(Counter)
        for w, s in mine:
            counts[s].update(t for t in w if t in held and held[t] >= documents)
        whole = sum(counts.values(), Counter())

        def share(count, mass, kept=kept):
            return 1 + 10**9 * (count + 5) // (mass + 5 * len(kept))

        p = {s: [share(c[t], c.total()) for t in kept] for s, c in counts.items()}
        q = [share(whole[t], whole.total()) for t in kept]
        for s in counts:
            pairs = [(o, sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True))) for o in counts if o != s]
            terms = [(t, a - b) for t, a, b in zip(kept, p[s], q, strict=True) if counts[s][t] and a > b]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, r) for r, (i, v) in enumerate(found, 1) if part == "pair" or r <= top}
    return out


def got(spark, rows, **options):
    found = [tuple(r) for r in audit.divergence(table(spark, rows), **options).collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_query_equals_sql(spark, sf_dir):
    df = catalog.op13_source_audit(spark, sf_dir)
    assert oracle.difference(df, oracle.connect(sf_dir), audit.SQL) is None


def test_equals_plain_integers_with_odd_rows(spark):
    draw = np.random.default_rng(4)
    words = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(90)] + ["Zé", "zz", "Éa", "éa", "ab1cd_ef"]
    rows = [
        (" ".join(draw.choice(words, draw.integers(0, 25))), str(draw.choice(["en", "de"])), f"s{draw.integers(0, 4)}")
        for _ in range(400)
    ]
    rows += [rows[0]] * 3 + [(None, "en", "silent"), ("", "xx", "only"), ("?", None, None), ("ab ac", None, "s1"), ("AB", "", None)]
    rows += [("ab " * 5000, "en", "long")]
    assert got(spark, rows, documents=20, top=7) == plain(rows, 20, 7)
    assert got(spark, rows, documents=1) == plain(rows, 1)


def test_many_terms_of_one_value_are_cut_in_byte_order(spark):
    words = [f"{a}{b}" for a in "zyxéwb" for b in "abcdefghijklmnop"]
    rows = [(" ".join(words), "en", "a")] * 2 + [("top top", "en", "a"), ("other " * 400, "en", "b")]
    found = got(spark, rows, documents=1)
    assert found == plain(rows, 1)
    assert sum(r[1:3] == ("a", "term") for r in found) == 50


def test_chunks_change_nothing(spark, monkeypatch):
    rows = [(f"w{chr(97 + i % 20)} x{chr(97 + i % 7)}", "en", f"s{i % 3}") for i in range(60)]
    whole = got(spark, rows, documents=2)
    monkeypatch.setattr(audit, "CELLS", 8)
    assert got(spark, rows, documents=2) == whole == plain(rows, 2)


def test_empty_table(spark):
    assert got(spark, []) == set()


def test_shares_beyond_64_bits(spark):
    n, base = [0, 10**12, 3 * 10**17], [10**18, 10**13, 3 * 10**17 + 5]
    expected = [1 + 10**9 * (c + 5) // b for c, b in zip(n, base, strict=True)]
    assert audit._shares(np.array(n), np.array(base)).tolist() == expected
    df = spark.createDataFrame(list(zip(n, base, strict=True)), "n long, base long")
    assert [r[0] for r in df.select(audit.share("n", "base")).collect()] == expected


def test_groups_without_terms_have_pairs_of_value_zero():
    groups = pa.table({"lang": ["x", "x"], "source": ["b", "a"], "base": [0, 0], "chunk": [0, 0]})
    terms = pa.table({"sources": pa.array([], pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())])))})
    assert audit._differences(terms, groups).to_pylist() == [
        {"lang": "x", "source": "a", "item": "b", "value": 0},
        {"lang": "x", "source": "b", "item": "a", "value": 0},
    ]
