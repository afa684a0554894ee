import random
import re

import pytest

from shopmart.llm.line_dedup import remove_repeated_runs


def brute(rows, m):
    """rows: (order, text) in document order."""
    seen, out = set(), []
    for text in rows:
        lines = [x for x in (text or "").split("\n") if re.search(r"[^ \t\n\r\x0b\x0c]", x)]
        gone = set()
        for i in range(len(lines) - m + 1):
            w = tuple(lines[i:i + m])
            if w in seen:
                gone.update(range(i, i + m))
            seen.add(w)
        runs = []
        for i in sorted(gone):
            if runs and runs[-1][1] == i:
                runs[-1][1] = i + 1
            else:
                runs.append([i, i + 1])
        out.append((len(lines), len(gone), runs, text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_against_brute_force(spark, m):
    rng = random.Random(m)
    vocab = ["a", "b ", "çé", "", "  ", "x\ty"] + [f"line {i}" for i in range(25)]
    texts = [None, "", "\n\n", "a", "a\na\na\na\na\na", "a\nb \nçé\nx\ty\nline 1\nline 2"]
    for _ in range(50):
        texts.append("\n".join(rng.choices(vocab, k=rng.randint(0, 12)) + rng.choice([[], ["line 3", "line 4", "", "line 5", "line 6", "line 7"]])))
    texts += [texts[-1], texts[-2], "z\n" * 400]
    rows = [(i, t, f"{i}", 1, "clash") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, pos string, rid int, rank string").repartition(5)
    got = {r.row.doc_id: r for r in remove_repeated_runs(df, min_lines=m).collect()}
    assert len(got) == len(texts)
    for i, want in enumerate(brute(texts, m)):
        r = got[i]
        assert (r.n_lines, r.n_removed, [[x.start, x.end] for x in r.removed], r.kept) == want, i
        assert r.row.pos == str(i) and r.row.rank == "clash"


def brute_long(texts, m, words):
    """Kept texts if lines of ``words`` words or more count alone."""
    seen, first, out = set(), set(), []
    for text in texts:
        lines = [x for x in (text or "").split("\n") if re.search(r"[^ \t\n\r\x0b\x0c]", x)]
        gone = set()
        for i, x in enumerate(lines):
            if x in first and len(re.findall(r"[^ \t\n\r\x0b\x0c]+", x)) >= words:
                gone.add(i)
            first.add(x)
            w = tuple(lines[i:i + m])
            if len(w) == m and w in seen:
                gone.update(range(i, i + m))
            seen.add(w)
        out.append((len(gone), text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


@pytest.mark.parametrize("m", [2, 3])
def test_long_lines_count_alone(spark, m):
    rng = random.Random(m)
    vocab = [f"line {i}" for i in range(12)] + [" ".join(f"w{i}" for i in range(j, j + n)) for j in range(3) for n in (4, 5, 6)] + ["a\tb  ü d e"]
    texts = [None, vocab[-2], "x\n" + vocab[-2] + "\ny", vocab[-2]]  # a document of one line, the line between others, the document again
    texts += ["\n".join(rng.choices(vocab, k=rng.randint(0, 9))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.row.doc_id: (r.n_removed, r.kept) for r in remove_repeated_runs(df, min_lines=m, long_words=5).collect()}
    assert [got[i] for i in range(len(texts))] == brute_long(texts, m, 5)
    assert got[2] == (1, "x\ny") and got[3] == (1, "")


def test_no_long_line_is_kept_twice(spark):
    """On the whole table: of lines of 20 words or more only the first copy stays, alone in their documents or not."""
    from shopmart.llm.queries import table
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    kept = remove_repeated_runs(docs, min_lines=2, long_words=20).select("kept").collect()
    lines = [x for r in kept for x in (r.kept or "").split("\n") if len(re.findall(r"[^ \t\n\r\x0b\x0c]+", x)) >= 20]
    assert lines and len(lines) == len(set(lines))
    before = [x for r in docs.collect() for x in set((r.text or "").split("\n")) if len(x.split()) >= 20]
    assert set(lines) == set(before) and len(before) > len(lines)


def test_null_and_repeated_ids(spark):
    t = "a\nb\nc"
    df = spark.createDataFrame([(1, t), (None, t), (1, t), (None, None)], "doc_id long, text string")
    got = sorted((r.row.doc_id or 0, r.n_removed, r.kept) for r in remove_repeated_runs(df).collect() if r.row.text)
    assert got == [(0, 0, t), (1, 3, ""), (1, 3, "")]
    same = spark.createDataFrame([(1, t), (1, t)], "doc_id long, text string")
    assert sorted(r.n_removed for r in remove_repeated_runs(same).collect()) == [0, 3]


def test_empty_table_and_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = remove_repeated_runs(df)
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()
