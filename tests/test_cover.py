import random

from pyspark.sql import functions as F

from cladeworks.operators import compose, cover, similarity, sketch
from cladeworks.plans import dereplicate


def greedy(nodes, edges):
    """The sequential rule, directly."""
    near = {n: set() for n in nodes}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    order = sorted(nodes, key=lambda n: (-len(near[n]), n))
    at = {n: i for i, n in enumerate(order)}
    reps, out = set(), {}
    for n in order:
        hit = near[n] & reps
        if hit:
            continue
        reps.add(n)
    for n in nodes:
        out[n] = n if n in reps else min(near[n] & reps, key=at.get)
    return out


def test_greedy_cover_is_sequential_greedy(spark):
    for seed, n, m, finish in ((1, 60, 70, 8), (2, 40, 300, 10**6), (3, 5, 0, 0)):
        r = random.Random(seed)
        nodes = list(range(n))
        edges = {tuple(sorted(r.sample(nodes, 2))) for _ in range(m)}
        deg = {i: sum(i in e for e in edges) for i in nodes}
        nd = spark.createDataFrame(list(deg.items()), "id bigint, degree bigint")
        ed = spark.createDataFrame(list(edges), "a bigint, b bigint")
        assert {x["id"]: x["rep"] for x in cover.greedy_cover(nd, ed, finish).collect()} == greedy(nodes, edges)


def docs(spark, seed=5, n=60):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        if i and r.random() < 0.5:
            words = rows[r.randrange(i)][1]
            words = (words or "").split()
            if words and r.random() < 0.7:
                words[r.randrange(len(words))] = f"w{r.randrange(9)}"
            rows.append((i, " ".join(words)))
        else:
            rows.append((i, " ".join(f"w{r.randrange(400)}" for _ in range(r.choice([2, 60, 80])))))
    rows += [(n, None), (n + 1, ""), (n + 2, "same " * 50)]
    return rows


def test_similarity_join_is_exact(spark):
    rows = docs(spark)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sk = sketch.word_sketch(df)
    sets = {}
    for r in sk.collect():
        sets.setdefault(r["id"], set()).add(r["h"])
    members = similarity.classes(sk)
    cls = {r["id"]: r["class_id"] for r in members.collect()}
    for i in sets:
        assert cls[i] == min(j for j in sets if sets[j] == sets[i])
    heads = sorted(set(cls.values()))
    want = {(a, b) for a in heads for b in heads if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    edges = similarity.class_edges(sk, members, 0.8)
    assert {(r["a"], r["b"]) for r in edges.collect()} == want and want
    clusters = dereplicate.cover_sketch(sk, df.select(F.col("doc_id").alias("id")), 0.8).collect()
    pairs = {(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8}
    rep = greedy(sorted(sets), pairs)
    assert {r["member"]: r["representative"] for r in clusters} == {**{i: i for i, _ in rows}, **rep}


def test_chunked_loses_nobody(spark):
    rows = docs(spark, 6, 30)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = dereplicate.chunked(sketch.word_sketch(df), df.select(F.col("doc_id").alias("id")), 8, 0.8)
    c = out.clusters.collect()
    assert {r["member"] for r in c} == {i for i, _ in rows} and len(c) == len(rows)
    status = {r["genome"]: r["status"] for r in out.status.collect()}
    assert {r["representative"] for r in c} == {g for g, s in status.items() if s == "representative"}


def test_chunk_ids(spark):
    for n in (5, 9):
        for k in (1, 2, 4):
            df = spark.createDataFrame([(i,) for i in range(n)], "id bigint")
            got = [r["chunk"] for r in compose.chunks(df, k, "id").orderBy("id").collect()]
            parts = [list(range(i, min(i + k, n))) for i in range(0, n, k)]
            if len(parts) > 1 and len(parts[-1]) == 1:
                tail = parts.pop()
                parts[-1] += tail
            want = [c for c, p in enumerate(parts) for _ in p]
            assert got == want, (n, k)


def test_search(spark):
    edges = spark.createDataFrame([(1, 2, 0.85), (2, 3, 0.9), (4, 5, 0.97)], "a bigint, b bigint, jaccard double")
    members = spark.createDataFrame([(i, i) for i in range(1, 7)], "id bigint, class_id bigint")
    t, n, trace = dereplicate.search_target(edges, members, 5)
    assert n == 5 and 0.9 < t <= 0.97 and trace[0][0] == 0.89995


def test_best_edges_and_reduce(spark, rows):
    e = spark.createDataFrame([("m", "r1", 99.0, 80.0, 90.0, 0), ("r2", "m", 99.0, 80.0, 90.0, 1), ("m2", "r1", 99.5, 10.0, 90.0, 2), ("r1", "r2", 99.9, 99.0, 99.0, 3)], "a string, b string, score double, fa double, fb double, ord int")
    reps = spark.createDataFrame([("r1",), ("r2",)], "id string")
    assert rows(compose.best_edges(e, reps, 97, 50)) == [("m", "r1", 99.0)]
    c = spark.createDataFrame([("a", "a"), ("a", "x"), ("b", "b"), ("c", "c"), ("d", "d")], "representative string, member string")
    t = spark.createDataFrame([("a", "G"), ("b", "G"), ("c", None), ("d", "")], "name string, genus string")
    assert rows(compose.reduce_by_taxon(c, t, ["genus"]), "representative", "member") == [("a", "a"), ("a", "b"), ("a", "x"), ("c", "c"), ("d", "d")]
    s2 = spark.createDataFrame([("a", "b"), ("a", "a")], "representative string, member string")
    assert rows(compose.compose(c, s2)) == [("a", "a"), ("a", "b"), ("a", "x"), ("c", "c"), ("d", "d")]
    failed = spark.createDataFrame([("a",), ("f",), (None,)], "genome string")
    assert ("f", "fail_qc") in rows(cover.statuses(c, failed)) and ("a", "representative") in rows(cover.statuses(c, failed))


def test_edges_from_pairs(spark, rows):
    p = spark.createDataFrame([("a", "b", "0.999"), ("a", "a", "1"), ("a", "z", "1"), ("b", "c", "0.5"), ("a", "c", "x"), ("b", "a", "nan")], "q string, m string, s string")
    known = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    assert rows(similarity.edges_from_pairs(p, "q", "m", "s", 0.99, known)) == [("a", "b"), ("b", "a")]


def test_words_of_any_script(spark):
    said = {
        "Το γονίδιο λείπει": ["το", "γονίδιο", "λείπει"], "Ген 12, ЕЩЁ": ["ген", "12", "ещё"], "Quixdoxünde_b1": ["quixdoxünde", "b1"], "ＧＣＦ＿７０ ｎ５": ["ｇｃｆ", "７０", "ｎ５"],
        "基因abc缺失,共7次": ["基", "因", "abc", "缺", "失", "共", "7", "次"], "हिन्दी में": ["हिन्दी", "में"], "GCA_1.2 --": ["gca", "1", "2"], "—": [], "": [],
    }
    df = spark.createDataFrame([(t,) for t in said], "text string")
    assert {r[0]: r[1] for r in df.select("text", sketch.words(F.col("text"))).collect()} == said


def test_near_duplicates_of_any_script(spark):
    r = random.Random(3)
    rows = []
    for k, (letters, gap) in enumerate([("абвгдежзиклмн", " "), ("αβγδεζηθικλμν", " "), ("基因序列长度样品菌株缺失", ""), ("ａｂｃｄｅｆｇｈｉｊ０１２", "\u3000"), ("àéîõüçñøåß", " ")]):
        made = ["".join(r.choice(letters) for _ in range(4)) for _ in range(60)]
        rows += [(10 * k, gap.join(made)), (10 * k + 1, gap.join([*made, made[0]])), (10 * k + 2, gap.join(r.sample(made, 60)))]
    # the same ids among different words
    rows += [(90 + i, " ".join(f"{w} gca 7000 1 n50 {n}" for n in range(30))) for i, w in enumerate(["Ген", "γονίδιο"])]
    got = dereplicate.by_sketch(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text").clusters.collect()
    assert {(x["representative"], x["member"]) for x in got if x["representative"] != x["member"]} == {(10 * k, 10 * k + 1) for k in range(5)}
