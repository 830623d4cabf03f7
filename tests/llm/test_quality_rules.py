from collections import defaultdict

from furiframe.llm.quality_rules import quality_rules

from .edge import edge_docs, edge_texts, empty_docs


def brute(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    seen = defaultdict(list)
    for i in range(len(words) - 2):
        seen[tuple(words[i: i + 3])].append(i)
    repeat = {p + k for at in seen.values() if len(at) > 1 for p in at for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat),
            len(words) < 50 or 100 * len(repeat) > 50 * len(words))


def test_edge_rows(spark):
    source = edge_texts() + [(900, "a b c a b c a b c " * 30), (901, "a a a a"), (902, "x y z " + "w %d " * 60 % tuple(range(60)) + "x y z")]
    docs = edge_docs(spark).select("doc_id", "text", "source").unionByName(
        spark.createDataFrame([(i, t, "s1") for i, t in source[-3:]], "doc_id long, text string, source string"))
    rows = quality_rules(docs).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert got == sorted((str(i), *brute(t or "")) for i, t in source)


def test_a_bad_host_takes_its_good_rows_along_and_small_or_null_hosts_do_not(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, good, f"host{i % 20}") for i in range(2000)]
    rows += [(5000 + i, "too short", "junk") for i in range(400)] + [(6000, good, "junk")]
    rows += [(7000, "too short", "tiny"), (7001, good, "tiny"), (8000, good, None), (8001, "too short", None)]
    out = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(out[i].kept for i in range(2000))
    assert out[6000].host_rejected and not out[6000].kept and not out[6000].base_failed
    assert out[7001].kept and not out[7000].kept and out[8000].kept and not out[8001].kept


def test_a_host_far_above_the_others_goes_under_one_half_and_an_even_corpus_stays(spark):
    good, schema = " ".join(f"word{i}" for i in range(80)), "doc_id long, text string, source string"

    def rows(host, n, failing, start):
        return [(start + i, "too short" if i < failing else good, host) for i in range(n)]

    def rejected(*hosts):
        out = quality_rules(spark.createDataFrame([r for k, h in enumerate(hosts) for r in rows(*h, 10000 * k)], schema))
        return {(r.doc_id // 10000) for r in out.where("host_rejected").collect()}

    low = [(f"low{i}", 200, 10) for i in range(5)]  # 5 %
    assert rejected(*low, ("high", 500, 200)) == {5}  # 40 %
    assert rejected(*low, ("some", 500, 60)) == set()  # 12 %: below the floor
    assert rejected(*low, ("few", 5, 2)) == set()  # 40 % of five rows
    assert rejected(*[(f"h{i}", 300, 120) for i in range(6)]) == set()  # all hosts at 40 %
    assert rejected(("a", 300, 15), ("b", 300, 120)) == {1}
    assert rejected(("alone", 300, 120)) == set() and rejected(("alone", 300, 290)) == {0}


def test_no_python_in_the_plan(spark, capsys):
    quality_rules(edge_docs(spark)).explain()
    assert "Python" not in capsys.readouterr().out


def test_empty_table(spark):
    assert quality_rules(empty_docs(spark)).collect() == []
