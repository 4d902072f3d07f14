from __future__ import annotations

import hashlib
import random

import oracle

from tidemark.llm import catalog, linetree


def got(df):
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in df.collect()}


def test_query_equals_sql(spark, sf_dir):
    df = catalog.op10_line_templates(spark, sf_dir)
    assert oracle.difference(df, oracle.connect(sf_dir), catalog.oracle_sql()["op10_line_templates"]) is None


def test_plan_runs_no_python(spark, sf_dir):
    plan = catalog.op10_line_templates(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "ArrowEval", "MapInArrow"))


def test_passages_fields_and_similar_lines_go_but_the_first(docs_of):
    passage = " ".join(f"w{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(55))
    notice = "Released under version {} of the general licence by its many authors today"
    found = got(
        linetree.drop_recurring(
            docs_of(
                (4, f"own text of four here\n{passage}\nlast line of four"),
                (2, f"{passage}\n\nown text of two here"),
                (7, notice.format("1.0") + "\nseven is seven and stays"),
                (8, notice.format("2.1") + "\neight is eight and stays"),
                (9, notice.format("3") + "\nnine is nine and stays"),
                (10, notice.format("4").replace("many", "few") + "\nten is ten and stays"),
                (11, notice.format("5").replace("general licence by its many authors today", "a b c d e f g")),
            )
        )
    )
    assert found[2] == (f"{passage}\n\nown text of two here", 3, 0)
    assert found[4] == ("own text of four here\nlast line of four", 3, 1)
    assert found[7][2] == 0 and found[8] == ("eight is eight and stays", 2, 1)
    assert found[10] == ("ten is ten and stays", 2, 1) and found[11][2] == 0


def test_short_lines_need_more_documents(docs_of):
    rows = [(i, f"all rights reserved\n{'i' * (i + 1)} opens a line unlike others\nhm") for i in range(9)]
    found = got(linetree.drop_recurring(docs_of(*rows[:8])))
    assert [found[i][2] for i in range(8)] == [0] * 8
    found = got(linetree.drop_recurring(docs_of(*rows)))
    assert [found[i][2] for i in range(9)] == [0] + [1] * 8
    assert all(found[i][0].endswith("hm") for i in range(9))


def test_nulls_white_space_repeats_and_other_columns(docs_of, empty_docs):
    line = "a line of many words that is found in every one of these documents without change at all"
    docs = docs_of(
        (1, None), (2, ""), (3, "\n\n"), (4, f"{line}\n{line}"), (4, f"{line}\n{line}"), (5, f" {line}\t\n "),
        (None, f"{line}\nnull id"), (6, f"{line}\n" * 3 + "é"), (6, "x y z"),
    )
    out = linetree.drop_recurring(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    rows = sorted(((r.doc_id is not None, r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str)
    assert rows == sorted(
        [
            (True, 1, None, 0, 0), (True, 2, "", 1, 0), (True, 3, "\n\n", 3, 0), (True, 4, "", 2, 2), (True, 4, "", 2, 2),
            (True, 5, " ", 2, 1), (False, None, f"{line}\nnull id", 2, 0), (True, 6, "é", 4, 3), (True, 6, "x y z", 1, 0),
        ],
        key=str,
    )
    assert linetree.drop_recurring(empty_docs).collect() == []


def test_a_very_long_text_and_a_hot_line(docs_of):
    hot = "one and the same line of words in a third of all rows"
    rows = [(i, f"{hot}\nrow {'z' * i} alone") for i in range(300)]
    rows.append((900, "\n".join(f"line {'q' * (i % 90)} {'v' * (i // 90)} of a long text" for i in range(20_000)) + f"\n{hot}"))
    found = got(linetree.drop_recurring(docs_of(*rows)))
    assert found[0][2] == 0 and all(found[i][2] == 1 for i in range(1, 300))
    assert found[900][1:] == (20_001, 1)


def test_numbers_that_are_not_shared_are_content(docs_of):
    rows = [(i, f"{i}.5 {i + 1}.1 {i * 7}\n{' '.join(f'{i * 31 + k}.25' for k in range(24))}\n2021-01-{10 + i} 11:{10 + i} ok 5 {i}e3") for i in range(12)]
    found = got(linetree.drop_recurring(docs_of(*rows)))
    assert [found[i] for i in range(12)] == [(text, 3, 0) for _, text in rows]
    same = " ".join(f"{k}.5" for k in range(24))
    near = same.replace("3.5 4.5", "8.8 9.9")
    found = got(linetree.drop_recurring(docs_of((1, f"{same}\none"), (2, f"{same}\ntwo"), (3, f"{near}\nthree"))))
    assert found == {1: (f"{same}\none", 2, 0), 2: ("two", 2, 1), 3: (f"{near}\nthree", 2, 0)}


def test_every_family_of_a_leaf_has_its_seed(docs_of):
    """Six lines that differ in a number and six that differ in a name share a leaf; both recur."""
    line = "This page is kept by {} for all readers who may look for older notes on the paths along our quiet river bank today"
    names = ["Ann", "Bea", "Cid", "Dov", "Eli", "Fay"]
    other = "This page is a list that {} wrote of seven green hills and many small lakes far from any road or town we know"
    rows = [(i, f"{line.format(i)}\n{'a' * (i + 1)} alone") for i in range(6)]
    rows += [(10 + i, f"{other.format(name)}\n{'b' * (i + 1)} alone") for i, name in enumerate(names)]
    found = got(linetree.drop_recurring(docs_of(*rows)))
    assert [found[i][2] for i in range(6)] == [0] + [1] * 5
    assert [found[10 + i][2] for i in range(6)] == [0] + [1] * 5


def test_lines_of_one_and_two_words_recur_in_many_documents(docs_of):
    rows = [(i, f"Read more\n{'w' * (i + 1)} opens line {'v' * (i + 1)}\nAdvertisement") for i in range(40)]
    found = got(linetree.drop_recurring(docs_of(*rows)))
    assert [found[i][2] for i in range(40)] == [0] + [2] * 39
    found = got(linetree.drop_recurring(docs_of(*rows[:12])))
    assert [found[i][2] for i in range(12)] == [0] * 12


def test_a_passage_on_short_lines_recurs_as_a_whole(docs_of):
    lines = [" ".join(f"{c}{chr(97 + k)}" for k in range(15)) for c in "pqrs"]
    passage = "\n".join(lines)
    spaced = "\n\n".join(lines)
    alone = lines[0]
    found = got(
        linetree.drop_recurring(
            docs_of((1, f"own one\n{passage}\nend one"), (2, f"own two\n{spaced}\nend two"), (3, f"own three\n{alone}\nend three"), (4, f"{lines[1]}\nbetween\n{lines[2]}"))
        )
    )
    assert found[1] == (f"own one\n{passage}\nend one", 6, 0)
    assert found[2] == ("own two\n\n\n\nend two", 9, 4)
    assert found[3] == ("own three\nend three", 3, 1) and found[4][2] == 2


def test_a_leaf_of_many_families_has_a_seed_for_each(docs_of):
    """Nine families of three lines that differ in a name, all in one leaf: no number of seeds is the last."""
    rng = random.Random(3)
    names = ["Ann", "Bea", "Cid"]
    families = [[f"{'xyz'[rng.randrange(3)]}{chr(97 + f)}{chr(97 + i)}" for i in range(26)] for f in range(9)]
    rows = []
    for f, words in enumerate(families):
        for k, name in enumerate(names):
            rows.append((10 * f + k, f"this page is {name} {' '.join(words)}\n{'a' * (3 * f + k + 1)} alone"))
    found = got(linetree.drop_recurring(docs_of(*rows)))
    assert [[found[10 * f + k][2] for k in range(3)] for f in range(9)] == [[0, 1, 1]] * 9


def test_lines_come_to_the_first_seed_they_agree_with(spark):
    """Held against a plain walk over the lines of each leaf, one by one, with one seed a round at first."""
    rng = random.Random(7)
    lines = {}
    for leaf, n in ((1, 5), (2, 10), (3, 17)):
        bases = [[rng.choice("abc") + str(i) for i in range(n)] for _ in range(6)]
        for _ in range(40):
            words = list(rng.choice(bases))
            for at in rng.sample(range(3, n), rng.randrange(n - 3)):
                words[at] = rng.choice("abcdef") + str(at)
            body = " ".join(["p", "q", "r", *words[3:]])
            lines.setdefault((leaf, body), (leaf, len(lines), rng.randrange(1, 4), body))
    want = set()
    for leaf in (1, 2, 3):
        order = [r for r in lines.values() if r[0] == leaf]
        order.sort(key=lambda r: (r[2], hashlib.md5(r[3].encode()).hexdigest()), reverse=True)
        seeds = []
        for _, line, _, body in order:
            words = body.split()
            near = [s for s, other in seeds if 100 * sum(a == b for a, b in zip(words, other, strict=True)) >= 70 * len(words)]
            if not near:
                seeds.append((line, words))
            want.add((leaf, line, near[0] if near else line))
    variants = spark.createDataFrame(list(lines.values()), "leaf long, line long, docs long, body string")
    found = {(r.leaf, r.line, r.template) for r in linetree._seeded(variants, 3, 70, 1).collect()}
    assert found <= want and all(line == template for _, line, template in want - found)
