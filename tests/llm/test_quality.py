import re

from pyspark.sql import functions as F

from flightlake.llm.quality import quality


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    hit = set()
    for i, x in enumerate(wins):
        if wins.count(x) > 1:
            hit |= set(range(i, i + 8))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)),
            len(lines) - len(set(lines)), len(hit))


TEXTS = [None, "", " \t\n\r\x0b\x0c ", "one", "a b c d e f g h", "the of and " * 30,
         "x y z", " ".join(f"w{i}" for i in range(60)), "#*$ %&| <> a\n\na\na b\n",
         " ".join(f"w{i % 9}" for i in range(40)), "ein wort " * 4 + "\U0001f600 ende",
         " ".join(f"the w{i} of" for i in range(40)) + "\n" + "same line here\n" * 2]


def test_measures_equal_brute_force(docs_of):
    got = {r.doc_id: r for r in quality(docs_of(TEXTS + TEXTS[5:6])).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, t in enumerate(TEXTS + TEXTS[5:6]):
        r = got[i]
        n, chars, sym, dup, rep = brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, sym, dup, rep), t
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n)
        assert not (r.kept and r.base_failed)


def test_long_text_and_rules(docs_of):
    prose = " ".join(f"the word{i} of many" for i in range(20000))
    rows = {r.doc_id: r for r in quality(docs_of([prose, prose.replace("the", "xyz").replace("of", "zyx")])).collect()}
    assert rows[0].kept and rows[0].n_words == 80000
    assert rows[1].failed == ["stop_words"] and not rows[1].kept


def test_no_python_and_no_shuffle(docs_of):
    plan = quality(docs_of(TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_empty_and_clashing_columns(docs_of):
    d = docs_of(TEXTS).withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(1))
    assert quality(d).count() == len(TEXTS)
    assert quality(d.limit(0)).count() == 0
