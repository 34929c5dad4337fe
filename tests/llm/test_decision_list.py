import random
import re
from collections import Counter

from sluiceway.llm import decision_list as dl

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_match_brute_force(odd, frame):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab# \n") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    docs = frame([(i, t, None, None, None) for i, t in enumerate(texts)])
    for df in (docs, odd):
        want = sorted(((r.doc_id, *brute(r.text)) for r in df.collect()), key=str)
        got = dl.text_statistics(df).select("doc_id", *NAMES).collect()
        assert sorted(map(tuple, got), key=str) == want


def labelled(spark, n=3000):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        x, y, z = rng.random(), rng.random(), rng.random()
        rows.append((i, x, y if i % 50 else None, z, (x > 0.8 and (y < 0.5)) or z > 0.95))
    return spark.createDataFrame(rows, "doc_id long, x double, y double, z double, bad boolean")


def test_rules_are_found_and_ordered(spark):
    rows = labelled(spark)
    made = dl.learn(rows, ["x", "y", "z"])
    assert made.rules and all(r.precision >= 0.9 for r in made.rules)
    judged = rows.withColumn("rejected", made.rejects()).withColumn("rule", made.which())
    right = judged.where("rejected = bad").count() / rows.count()
    assert right > 0.97
    assert judged.where("rejected <> (rule IS NOT NULL)").count() == 0


def test_nothing_to_learn(spark):
    rows = labelled(spark, 60).withColumn("bad", __import__("pyspark").sql.functions.lit(False))
    assert dl.learn(rows, ["x", "y", "z"]) == dl.DecisionList()
    assert dl.learn(rows.limit(0), ["x", "y", "z"]) == dl.DecisionList()


def test_judge_odd_rows_without_labels(odd, spark):
    labels = spark.createDataFrame([(2, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = dl.judge(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert all(r.kept == (not r.base_failed) for r in rows)


def test_no_python_in_the_plan(odd):
    plan = dl.text_statistics(odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Exchange"))


def test_empty(empty, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert dl.judge(empty, labels).count() == 0


def plain_list(rows, statistics, bins=32, min_precision=0.9, min_covered=10):
    """The list learned in plain Python from collected rows, step by step."""
    import math

    def step(v):
        return 0 if v == 0 else math.copysign(1, v) * (math.floor(math.log2(abs(v)) * 64) + 100_000)

    cuts = {}
    for s in statistics:
        values = sorted((r[s], r["bad"]) for r in rows if r[s] is not None)
        tops = {}
        for v, _ in values:
            tops[step(v)] = max(v, tops.get(step(v), v))
        found = set()
        for some in (values, [x for x in values if x[1]]):
            total, share = len(some), 1
            for at in sorted({tops[step(v)] for v, _ in some}):
                before = sum(v <= at for v, _ in some)
                if share < bins and before * bins >= share * total:
                    found.add(at)
                    share = before * bins // total + 1
        cuts[s] = sorted(found)

    def holds(r, rule):
        return all(r[s] is not None and (r[s] > at) == above for s, above, at in rule)

    made, left = [], rows
    while True:
        grown, part = [], [r for r in left if not r["prunes"]]
        while True:
            here = [r for r in part if holds(r, grown)]
            per = {s: [r for r in here if r[s] is not None] for s in statistics}
            bad, good = max(((sum(r["bad"] for r in x), sum(not r["bad"] for r in x)) for x in per.values()), default=(0, 0))
            if not bad or not good:
                break
            start, best = math.log2(bad / (bad + good)), (0.0, None)
            for s in sorted(statistics):
                for at in cuts[s]:
                    for above in (False, True):
                        side = [r["bad"] for r in per[s] if (r[s] > at) == above]
                        p = sum(side)
                        if p:
                            gain = p * (math.log2(p / len(side)) - start)
                            if gain > best[0] + 1e-9:
                                best = (gain, (s, above, at))
            if best[1] is None:
                break
            grown.append(best[1])
        best = None
        for k in range(1, len(grown) + 1):
            every = [r for r in left if holds(r, grown[:k])]
            pruning = [r["bad"] for r in every if r["prunes"]]
            p, n = sum(pruning), len(pruning) - sum(pruning)
            if p and len(every) >= min_covered and p >= min_precision * (p + n):
                worth = (p - n) / (p + n)
                if best is None or worth > best[0]:
                    best = (worth, grown[:k], (sum(r["bad"] for r in every) + 1) / (len(every) + 2))
        if best is None or best[2] < min_precision:
            return made
        made.append(best[1])
        left = [r for r in left if not holds(r, best[1])]


def test_the_list_against_plain_python(spark):
    from pyspark.sql import functions as F

    rows = labelled(spark, 400)
    third = F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0
    plain = [r.asDict() for r in rows.withColumn("prunes", third).collect()]
    made = dl.learn(rows.repartition(5), ["x", "y", "z"])
    assert [[(c.statistic, c.above, c.at) for c in r.conditions] for r in made.rules] == plain_list(plain, ["x", "y", "z"])
    assert made.rules


def test_rules_are_learned_from_the_small_table(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = dl.judge(docs, labels).join(labels, "doc_id")
    caught = judged.where("quality = 0 AND rule IS NOT NULL").count()
    assert caught >= 0.7 * judged.where("quality = 0").count()
    assert judged.where("quality = 1 AND rule IS NOT NULL").count() <= 0.01 * judged.where("quality = 1").count()


def test_a_very_long_text(frame):
    text = "\n".join(f"line {i % 1000} of many # lines" for i in range(30_000))
    got = dl.text_statistics(frame([(1, text, None, None, None)])).select(*NAMES).first()
    assert tuple(got) == brute(text)
