"""Near duplicates, lines and sentence spans against brute force."""

import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from cases import CLASHING, documents, odd_rows

from tidemark.llm import lines, minhash, spans
from tidemark.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def groups(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, percent=75):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    links = []
    for a in sets:
        for b in sets:
            if a < b and any(
                x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]
            ):
                links.append((a, b))
    return groups(links, sets)


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, n) for n in range(200, 400)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    rng.shuffle(links)
    frame = spark.createDataFrame([*links, (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    expected = groups(links, {n for link in links for n in link})
    assert got == {n: c for n, c in expected.items() if n != c}


def test_components_without_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("most", [3, 12])
def test_near_duplicates_equal_brute_force(spark, most):
    rng = random.Random(most)
    rows, base = [], [f"w{rng.random()}" for _ in range(80)]
    for i in range(120):
        rows.append((i * 3 + 1, edited(base, rng.randrange(most), rng)))
    for i in range(60):
        own = [f"v{rng.random()}" for _ in range(rng.randrange(1, 40))]
        rows += [(1000 + 3 * i + k, edited(own, k, rng).upper()) for k in range(3)]
    got = {r.doc_id: r for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    expected = brute(rows)
    assert {i: r.component_id for i, r in got.items()} == expected
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingles(t)) for i, t in rows}
    assert all(r.kept == (i == expected[i]) for i, r in got.items())


def test_near_duplicates_in_buckets_of_several_components(spark, monkeypatch):
    # With a leader more a round, every rule for leaders and several rounds come into play.
    monkeypatch.setattr(minhash, "_LEADERS", 2)
    rng = random.Random(21)
    rows, base = [], [f"w{rng.random()}" for _ in range(90)]
    for i in range(150):
        rows.append((i, edited(base, rng.choice([0, 2, 3, 4, 4, 5, 5, 6]), rng)))
    rows += [(i, edited(base[:60], 1, rng)) for i in range(140, 170)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == brute(rows)


def test_occupied_parts_bound_intersections():
    rng = np.random.default_rng(3)
    for n in (1, 5, 100, 3000):
        a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for _ in range(2))
        b[: n // 2] = a[: n // 2]
        both = np.intersect1d(a, b).size
        left, right = (minhash.occupied(x).view(np.uint64) for x in (a, b))
        assert both <= n - np.bitwise_count(left & ~right).sum()


@pytest.mark.parametrize("extra", ("class_id",))
def test_near_duplicates_of_odd_rows(spark, extra):
    frame = documents(spark, odd_rows(), extra)
    got = minhash.near_duplicates(frame).collect()
    assert len(got) == len(odd_rows())
    ids = {r.doc_id: r.component_id for r in got}
    assert ids == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, None: None}
    assert all(r.kept == (r.doc_id not in (2, 7)) for r in got)
    kept = minhash.without_near_duplicates(frame)
    assert kept.columns == frame.columns and kept.count() == len(odd_rows()) - 2
    assert minhash.near_duplicates(frame.limit(0)).count() == 0


def windows_gone(rows, parts_of, size, counts):
    """Parts left of each ``(doc_id, text)`` when later windows are taken out."""
    first, gone = {}, {}
    for i, t in sorted({r for r in rows if r[0] is not None and r[1] is not None}):
        parts = parts_of(t)
        for k in range(len(parts) - size + 1):
            run = tuple(parts[k : k + size])
            if counts(run) and first.setdefault(run, (i, t, k)) != (i, t, k):
                gone.setdefault((i, t), set()).update(range(k, k + size))
    return gone


def test_lines_equal_brute_force_and_sql(spark):
    rng = random.Random(4)
    common = [f"line {i}" for i in range(12)]
    texts = ["\n".join(rng.choice(common) for _ in range(rng.randrange(1, 30))) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate([*texts, "a\n\n\n\n\n\nb", "", "a\na\na\na\na\na"])]
    frame = documents(spark, rows)
    got = {r.doc_id: r for r in lines.repeated_lines_removed(frame).collect()}
    gone = windows_gone(rows, lambda t: t.split("\n"), 3, lambda run: "".join(run).strip(" "))
    for i, t in rows:
        all_lines = t.split("\n")
        left = [x for k, x in enumerate(all_lines) if k not in gone.get((i, t), ())]
        assert (got[i].text, got[i].n_lines) == ("\n".join(left), len(all_lines))
        assert got[i].n_removed == len(all_lines) - len(left)
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    expected = {r[0]: r[1:] for r in con.execute(lines.oracle_sql()).fetchall()}
    assert {i: (r.n_lines, r.n_removed, r.text) for i, r in got.items()} == expected


@pytest.mark.parametrize("extra", CLASHING[1:4])
def test_odd_rows_in_lines_and_spans(spark, extra):
    frame = documents(spark, odd_rows(), extra)
    for out in (lines.repeated_lines_removed(frame), spans.repeated_spans_removed(frame, least_words=6)):
        got = out.collect()
        assert len(got) == len(odd_rows()) and len(set(out.columns)) == len(out.columns)
        texts = {r.doc_id: r.text for r in got if r.doc_id not in (2, 7, None)}
        assert texts == {i: t for i, t in odd_rows() if i not in (2, 7, None)}
        assert [r.text for r in got if r.doc_id == 2] == [""]
    chars = lines.without_repeated_lines(frame)
    assert chars.columns == frame.columns
    assert chars.where("doc_id = 2").first().n_chars == 0
    assert lines.repeated_lines_removed(frame.limit(0)).count() == 0
    assert spans.repeated_spans_removed(frame.limit(0)).count() == 0


def test_lines_run_no_python(spark):
    frame = lines.repeated_lines_removed(documents(spark, [(1, "a\nb\nc"), (2, "a\nb\nc")]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_spans_equal_brute_force(spark):
    rng = random.Random(9)

    def sentence():
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 9)))

    passages = [". ".join(sentence() for _ in range(12)) for _ in range(5)]
    rows = []
    for i in range(60):
        own = [sentence() for _ in range(rng.randrange(1, 12))]
        if i % 2:
            own.insert(rng.randrange(len(own)), rng.choice(passages))
        rows.append((i, ", ".join(own[:2]) + ".\n" + ". ".join(own[2:])))
    got = {r.doc_id: r for r in spans.repeated_spans_removed(documents(spark, rows)).collect()}
    cut = re.compile(r"(?<=[.!?;:,][ \t\r])|(?<=\n)")

    def parts(text):
        return [p.strip(" \t\n\r\x0b\x0c") for p in cut.split(text.lower())]

    gone = windows_gone(rows, parts, 3, lambda run: " ".join(run).count(" ") + 1 >= 12)
    assert gone
    for i, t in rows:
        pieces = cut.split(t)
        left = [p for k, p in enumerate(pieces) if k not in gone.get((i, t), ())]
        assert got[i].text == "".join(left)
        assert got[i].n_removed == len(pieces) - len(left)
        assert bool(got[i].repeats_of) == bool(got[i].n_removed)


def test_spans_catch_passages_of_long_sentences(spark):
    rng = random.Random(4)

    def some(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    rows = []
    for i in range(40):
        passage = some(60)
        rows += [(2 * i, " ".join(some(15) + passage + some(9))), (2 * i + 1, " ".join(some(22) + passage + some(30)))]
    got = {r.doc_id: r for r in spans.repeated_spans_removed(documents(spark, rows)).collect()}
    assert all(got[i].text == t for i, t in rows if i % 2 == 0)
    assert sum(got[i].n_removed > 0 and got[i].repeats_of == [i - 1] for i, _ in rows if i % 2) >= 36


def sentences_of(text):
    """Sentences by places between characters, long ones cut behind chosen words."""
    found, start, words = [], 0, 0
    for i in range(1, len(text) + 1):
        ended = text[i - 1] == "\n" or (i > 1 and text[i - 1] in " \t\r" and text[i - 2] in ".!?;:,")
        if ended or i == len(text):
            found.append(text[start:i])
            start = i
            if ended and i == len(text):
                found.append("")
    cut = []
    for sentence in found or [""]:
        part, words = "", 0
        spaces = sentence.count(" ")
        for token in re.split(r"(?<=[ \t\r])(?=[^ \t\r])", sentence):
            part += token
            words += bool(token.strip(" \t\r"))
            key = token.strip(" \t\n\r\x0b\x0c").lower().encode()
            if spaces >= 8 and words > 8 and zlib.crc32(key) % 5 == 0:
                cut.append(part)
                part = ""
        if part or spaces < 8:
            cut.append(part)
    return cut


def test_spans_of_long_sentences_equal_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [f"{c}ord{i}" for i, c in enumerate("wWéÉßİ🙂v" * 40)]

    def some(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" "] * 30 + [", ", ". ", "\n", "  ", " \t"]) for _ in range(n))

    passages = [some(60) for _ in range(6)]
    rows = [(i, some(rng.randrange(60)) + (rng.choice(passages) if i % 3 else "") + some(rng.randrange(60))) for i in range(70)]
    rows += [(100, ""), (101, "x" * 50_000 + " "), (102, " " * 40), (103, some(20_000)), (103, rows[1][1])]
    got = {(r.doc_id, r.n_sentences): r for r in spans.repeated_spans_removed(documents(spark, rows)).collect()}

    def parts(text):
        return [p.strip(" \t\n\r\x0b\x0c").lower() for p in sentences_of(text)]

    # Rows of one id are told apart by a hash of their text, which brute force can't order.
    gone = windows_gone(rows, parts, 3, lambda run: " ".join(run).count(" ") + 1 >= 12)
    assert len(gone) > 30
    for i, t in rows:
        cut = sentences_of(t)
        assert "".join(cut) == t and spans.pieces(t) == cut
        r = got[i, len(cut)]
        assert r.text == "".join(p for k, p in enumerate(cut) if k not in gone.get((i, t), ()))
        assert r.n_removed == len(gone.get((i, t), ()))


def test_spans_cut_texts_with_null_ids_and_keep_odd_bytes(spark):
    frame = documents(spark, [(None, "a. b. c"), (None, "a. b. c"), (1, None), (2, "a. b")])
    got = spans.repeated_spans_removed(frame, least_words=1).collect()
    assert sorted((r.doc_id or 0, r.n_sentences, r.n_removed) for r in got) == [(0, 3, 0), (0, 3, 0), (1, 0, 0), (2, 2, 0)]


def test_spans_catch_a_pasted_passage_and_leave_clean_text(spark):
    passage = "And so it was, said the old man, that nobody came back; the road was long, " * 4
    clean = "This text is nobody else's. It stands alone. Nothing in it is repeated anywhere at all."
    rows = [(1, f"Start here {passage}and go on."), (2, f"Other words {passage}then stop."), (3, clean)]
    got = {r.doc_id: r for r in spans.repeated_spans_removed(documents(spark, rows)).collect()}
    assert got[3].n_removed == 0 and got[3].text == clean
    assert got[2].n_removed > 0 and 1 in got[2].repeats_of
    assert len(got[2].text) < len(rows[1][1]) / 2
