import random
import re

import pytest

from gaugeline.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    words, windows, covered = WORD.findall(text), {}, set()
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in windows.values():
        if len(places) > 1:
            covered |= {j for i in places for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


PROSE = "the cat and a dog went to the house of an old man who was in the garden by the river\n"


def texts():
    rng = random.Random(2)
    found = [None, "", " \n\t ", "one", PROSE, PROSE * 3, "a " * 7, "a " * 8, "a " * 9, "a " * 400, "é\xa0ü x y"]
    found += ["x\r\ny\r\n\nx\r\n x", "# * $ % & | < > ##", "b " * 20000, " ".join(map(str, range(30000)))]
    for _ in range(30):
        found.append(" ".join(rng.choices("abcde", k=rng.randint(8, 80))) + rng.choice(["", "\n", "!!"]))
    return found


def test_counts(spark, documents):
    rows = [(i, t, "s") for i, t in enumerate(texts())]
    found = quality_rules.judge(documents(rows)).select("doc_id", "measures.*", "base_failed").collect()
    for r in found:
        expected = slow(rows[r["doc_id"]][1])
        own = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert own == expected, rows[r["doc_id"]][1][:60]
        assert r["base_failed"] == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])


GOOD = " ".join(f"{w}{i}" if i % 4 else w for i, w in enumerate(PROSE.split() * 4))


@pytest.mark.parametrize(
    "text, rule",
    [
        (GOOD, None),
        ("so short", "too_short"),
        (PROSE * 3, "repeats"),
        (" ".join(f"{w}***" for w in GOOD.split()), "symbols"),
        (" ".join(f"{w}!!" for w in GOOD.split()), "shouting"),
        (" ".join(f"zq{i}x" for i in range(60)), "stop_words"),
        (" ".join("the" + "x" * 40 + str(i) for i in range(40)) + " the of and", "word_length"),
        ("\n".join(["the same line of it"] * 6 + GOOD.split()[:5]) + " ".join(f"the{i} of" for i in range(40)), "duplicate_lines"),
    ],
)
def test_verdicts(spark, documents, text, rule):
    r = quality_rules.judge(documents([(1, text, "s")])).first()
    assert r["kept"] == (rule is None) and (rule is None or rule in r["failed"])


def test_one_projection_of_built_in_functions(spark, documents):
    judged = quality_rules.judge(documents([(1, GOOD, "s")]))
    shown = judged._jdf.queryExecution().executedPlan().toString()
    assert not any(x in shown for x in ("Exchange", "Python", "Pandas", "Arrow"))


def test_columns_stay_and_own_names_are_replaced(spark, documents):
    docs = documents([(None, GOOD, None), (None, GOOD, None)])
    judged = quality_rules.judge(docs)
    assert set(docs.columns) - {"kept"} <= set(judged.columns) and judged.columns.count("kept") == 1
    assert [r["kept"] for r in judged.collect()] == [True, True]
    assert quality_rules.judge(documents([])).collect() == []
