"""URL filters, toxicity, decontamination and the pipeline."""

import random
import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from cases import documents, odd_rows

import __spark_entry__ as contract
from tidemark.llm import decontaminate, lines, minhash, queries, toxicity, url_graph

RULES = queries.URL_RULES


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, rank string")


def expected_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, max(fits)[1] if fits else None


URLS = [
    None, "", "no scheme", "http://A.Example.ORG/es/1?x#y", "http://example.org/en/12", "http://example.org",
    "https://x.org/", "https://xorg/", "http://a.com/fr/", "http://a.com/de/x", "http://a.com?fr/", "a://b://c.org/d",
    "http://h#/x.org/", "http://É.com/fr/\nline", "http://a.net/q",
]


def test_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)]
    got = {r.page_id: r for r in url_graph.filter_urls(pages(spark, rows), RULES).collect()}
    assert len(got) == len(URLS)
    for i, url, _ in rows:
        host, path, rule = expected_rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        if rule:
            assert got[i].verdict == next(v for v, h, p in RULES if h + p == rule)
    assert url_graph.filter_urls(pages(spark, rows).limit(0), RULES).count() == 0


def rank(edges, seeds):
    total = sum(seeds.values())
    own = {h: s / total for h, s in seeds.items() if s}
    ranks = dict(own)
    for _ in range(url_graph.ROUNDS):
        new = {h: s * (1 - url_graph.DAMPING) for h, s in own.items()}
        for a, b in edges:
            degree = sum(x == a for x, _ in edges)
            if a in ranks:
                new[b] = new.get(b, 0) + ranks[a] * url_graph.DAMPING / degree
        ranks = new
    return ranks


def test_trust_and_distrust_spread_over_links(spark):
    rng = random.Random(3)
    hosts = ["a.org", "b.org", "e.example.org", "c.com", "d.com", *(f"h{i}.net" for i in range(8))]
    rows, edges = [], set()
    for i in range(90):
        host, path = rng.choice(hosts), rng.choice(["/es/1", "/de/1", "/fr/1", "/q"])
        targets = [rng.choice(hosts) for _ in range(rng.randrange(4))]
        html = "".join(f'<A class=x href="http://{t.upper()}/x?y">.</a><a href="/in">' for t in targets)
        rows.append((i, f"http://{host}{path}", html if targets else None))
        edges |= {(host, t) for t in targets if t != host}
    got = {r.page_id: r for r in url_graph.filter_urls(pages(spark, rows), RULES).collect()}
    seeds = {"allow": {}, "block": {}}
    for host in {r.host for r in got.values()}:
        own = [expected_rule(u)[2] for _, u, _ in rows if expected_rule(u)[0] == host]
        verdict = {h + p: v for v, h, p in RULES}
        for kind, shares in seeds.items():
            shares[host] = sum(verdict.get(r) == kind for r in own) / len(own)
    trust, distrust = rank(edges, seeds["allow"]), rank({(b, a) for a, b in edges}, seeds["block"])
    for r in got.values():
        assert r.trust == pytest.approx(trust.get(r.host, 0))
        assert r.distrust == pytest.approx(distrust.get(r.host, 0))
        if r.rule is None:
            assert r.verdict == ("block" if r.distrust > r.trust else "allow")


def labelled(spark, n=900):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    rows, marks = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(15, 120))]
        toxic = int(rng.random() < 0.2)
        for _ in range(toxic * rng.randrange(2, 5)):
            words[rng.randrange(len(words))] = rng.choice(["wretched", "Worthless", "filthy", "disgusting"])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, toxic))
    return rows, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxicity_holds_on_held_out_rows(spark):
    rows, labels = labelled(spark)
    frame = documents(spark, rows, "toxic")
    model = toxicity.fit(frame, labels)
    joined = toxicity.scored(frame, model).withColumn("held", toxicity.held_out()).join(labels, "doc_id")
    held = joined.where("held").toPandas()
    assert 100 < len(held) < 300
    assert (held.predicted == held.toxic).mean() > 0.95
    assert held.score.between(0, 1).all() and ((held.score >= 0.5) == held.predicted.astype(bool)).all()
    kept = toxicity.without_toxic(frame, model)
    assert kept.columns == frame.columns and kept.count() < frame.count()
    # Labels of held out rows are not looked at.
    wrong = labels.withColumn("toxic", toxicity.held_out().cast("int")).where(toxicity.held_out())
    assert toxicity.fit(frame, labels.where(~toxicity.held_out()).union(wrong)) == model


def test_toxic_words_may_be_short_or_rare(spark):
    ordinary = [(0, f"the old house by sea number{i % 50}") for i in range(1600)]
    toxic = [(1, f"the old house by sea number{i % 50}" + " zog" * (i % 2) + " grumblefink" * (i < 10)) for i in range(800)]
    found = toxicity._toxic_words(spark.createDataFrame(ordinary + toxic, "toxic int, text string"))
    # One in two toxic texts has the word of three letters, one in eighty the rare one.
    assert found == b" grumblefink zog "
    pair = toxicity.Model(found, b"", (0.0,) * 4).compressors()
    assert toxicity.savings(b"zog", pair, {})[0] >= 1 and toxicity.savings(b"sea", pair, {})[0] < 1


@pytest.mark.parametrize("extra", ("toxic",))
def test_toxicity_of_odd_rows(spark, extra):
    frame = documents(spark, odd_rows(), extra)
    for labels in ([], [(2, 1, 1)], [(2, 1, 0), (None, 1, 1), (6, 1, None)], [(1, 0, 1), (2, 0, 0), (4, 0, 0), (6, 0, 0)]):
        model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        got = toxicity.scored(frame, model).collect()
        assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(frame.limit(0), model).count() == 0


def brute_leaks(rows, items):
    out = {}
    for i, text in rows:
        words = decontaminate.item_words((text or "").encode())
        for k, item in items:
            own = decontaminate.item_words((item or "").encode())
            if k is None or len(own) < decontaminate.SHORTEST_ITEM:
                continue
            most = decontaminate.most_edits(len(own), decontaminate.EDITS)
            # A window within reach has all but so many words out of the item.
            shared = np.concatenate([[0], np.cumsum(np.isin(words, own))])
            last = np.minimum(np.arange(len(words)) + len(own), len(words))
            starts = np.flatnonzero(shared[last] - shared[:-1] >= len(own) - most).tolist()
            found = [(decontaminate.distance(own, words[s : s + len(own)]), s) for s in starts]
            if found and min(found)[0] <= most:
                out[i, k] = min(found)
    return out


def test_leaks_reach_the_recall_of_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([8, 12, 20, 40])))) for k in range(40)]
    rows = []
    for i in range(160):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        if i % 4:
            own = rng.choice(items)[1].split()
            for _ in range(rng.randrange(int(len(own) * 0.2) + 1)):
                at = rng.randrange(len(own))
                own[at : at + 1] = rng.choice([[], ["new"], ["new", own[at]]])
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + rng.choice(["", "!", ",\n"]) for w in own]
        rows.append((i, " ".join(words)))
    benchmark = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, keys string")
    got = {
        (r.doc_id, r.item_id): (r.distance, r.start)
        for r in decontaminate.contaminated(documents(spark, rows), benchmark).collect()
    }
    expected = brute_leaks(rows, items)
    assert len(expected) > 80 and got.keys() <= expected.keys()
    assert all(got[k][0] >= expected[k][0] for k in got)
    assert len(got) >= 0.97 * len(expected)
    exact = [k for k, (d, _) in expected.items() if d == 0]
    assert exact and all(got[k][0] == 0 for k in exact)


@pytest.mark.parametrize("n", [40, 60, 100, 200])
def test_walks_meet_items_at_the_limit_of_edits(n):
    rng, c = np.random.default_rng(n), decontaminate.length_class(n)
    most = decontaminate.most_edits(n, decontaminate.EDITS)
    items = rng.integers(1, 2**63, (100, n), dtype=np.uint64)
    leaks = items.copy()
    for leak in leaks:
        leak[rng.choice(n, most, replace=False)] = rng.integers(1, 2**63, most, dtype=np.uint64)
    # The window of a document is as wide as the widest item of the class.
    wide = np.hstack([leaks, rng.integers(1, 2**63, (100, n), dtype=np.uint64)])
    starts = np.arange(100)
    own = decontaminate.lsh_keys(items.ravel(), starts * n, (starts + 1) * n, c)
    seen = decontaminate.lsh_keys(wide.ravel(), starts * 2 * n, starts * 2 * n + decontaminate.class_lengths(c)[1], c)
    assert (own == seen).any(axis=1).sum() >= 95


def test_many_words_are_walked_at_once(monkeypatch):
    calls, keys = [], decontaminate.lsh_keys
    monkeypatch.setattr(decontaminate, "lsh_keys", lambda *given: calls.append(given[3]) or keys(*given))
    rng = np.random.default_rng(1)
    hashed = [rng.integers(0, 2**62, 10_000).astype(np.uint64) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(range(60)), pa.array([b""] * 60)], ["a", "b", "c"])
    given = iter(hashed)
    monkeypatch.setattr(decontaminate, "item_words", lambda text: next(given))
    runs = np.zeros(1 << 23, bool)
    for found in hashed:
        runs[decontaminate.run_bits(found[:50])] = True
    for part in decontaminate._parts(batch):
        list(decontaminate._near(part, runs, np.zeros(1 << 23, bool), [0, 5], 0.2))
    assert calls == [0, 5]


def test_edit_distance_of_long_sequences():
    rng = np.random.default_rng(2)
    for n in (0, 1, 64, 65, 200):
        x, y = (rng.integers(0, 9, n + k).astype(np.uint64) for k in (0, 3))
        table = np.arange(len(y) + 1)
        for i, symbol in enumerate(x):
            row = [i + 1]
            for j, other in enumerate(y):
                row.append(min(row[-1] + 1, table[j + 1] + 1, table[j] + (symbol != other)))
            table = np.array(row)
        assert decontaminate.distance(x, y) == decontaminate.distance(y, x) == table[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        x, y = ([rng.randrange(4) for _ in range(rng.randrange(9))] for _ in range(2))
        table = np.zeros((len(x) + 1, len(y) + 1), int)
        table[:, 0], table[0] = range(len(x) + 1), range(len(y) + 1)
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                table[i + 1, j + 1] = min(table[i, j] + (a != b), table[i, j + 1] + 1, table[i + 1, j] + 1)
        assert decontaminate.distance(np.array(x, np.uint64), np.array(y, np.uint64)) == table[-1, -1]


@pytest.mark.parametrize("extra", ("_row", "start"))
def test_leaks_in_odd_rows(spark, extra):
    schema = "item_id long, text string"
    frame = documents(spark, [*odd_rows(), (None, "one two three four five six seven eight")], extra)
    odd = [(1, "ONE two, three four five six seven eight"), (2, None), (3, ""), (None, "x " * 9), (4, "a row"), (1, "y " * 9)]
    got = decontaminate.contaminated(frame, spark.createDataFrame(odd, schema)).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 1), (1, 1), (2, 1)]
    none = spark.createDataFrame([], schema)
    assert decontaminate.contaminated(frame, none).count() == 0
    kept = decontaminate.without_contamination(frame, spark.createDataFrame(odd, schema))
    assert kept.columns == frame.columns
    # Rows without id go together.
    assert kept.count() == len(odd_rows()) - 5
    assert decontaminate.contaminated(frame.limit(0), none).count() == 0


def test_pipeline_equals_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    scores = toxicity.scored(docs, toxicity.fit(docs, labels)).collect()
    left = {r.doc_id: texts[r.doc_id] for r in scores if not r.predicted}
    frame = documents(spark, sorted(left.items()))
    left = {r.doc_id: r.text for r in lines.repeated_lines_removed(frame).collect()}
    frame = documents(spark, sorted(left.items()))
    left = {r.doc_id: left[r.doc_id] for r in minhash.near_duplicates(frame).collect() if r.kept}
    leaks = brute_leaks(sorted(left.items()), [(r.item_id, r.text) for r in benchmark.collect()])
    left = {i: t for i, t in left.items() if i not in {d for d, _ in leaks}}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == {i: library.encode(t) for i, t in left.items()}
    assert 0 < len(got) < len(texts)


@pytest.mark.parametrize("n", [0, 100])
def test_stages_keep_the_columns_of_odd_rows(spark, sf_dir, n):
    docs = documents(spark, odd_rows()).limit(n)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() <= n


def test_every_operator_is_registered():
    names = contract.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and "op6_line_dedup" in contract.oracle_sql()
