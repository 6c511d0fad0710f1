import numpy as np

from prepforge.llm import embeddings as E


def brute(rows):
    ok = [i for i, (d, e, l) in enumerate(rows) if d is not None and l is not None and e and
          all(x is not None and np.isfinite(x) for x in e) and any(e)]
    comp, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], np.float32).astype(float), np.array(rows[b][1], np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    i, j = find(a), find(b)
                    comp[max(i, j)] = min(i, j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((str(r[0]), links[i], str(least.get(find(i)) if r[0] is not None else None))
                   for i, r in enumerate(rows)))


def test_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE", 7)
    r = np.random.default_rng(5)
    rows, nid = [], 900
    for c in range(12):
        center = r.standard_normal(16)
        for i in range(int(r.integers(1, 30))):
            nid -= 1
            rows.append((nid, (center * r.uniform(.1, 9) + r.normal(0, .03, 16)).tolist(), c % 3))
    rows += [(2000 + i, [1.0] * 16, 1) for i in range(20)]
    rows += [(1, None, 1), (2, [0.0] * 16, 1), (3, [None] + [1.0] * 15, 1), (4, [float("nan")] + [1.0] * 15, 1),
             (5, [1.0] * 16, None), (6, [1.0] * 8, 1), (7, [], 1), (None, [1.0] * 16, 1), (8, [float("inf")] * 16, 1),
             (9, [2.0] * 8, 1), (10, [1e30] * 16, 1), (9, [2.0] * 8, 1)]
    df = spark.createDataFrame([(*x, "k", 0) for x in rows], "vec_id long, embedding array<float>, label int, keys string, n int")
    got = E.cosine_groups(spark, df).collect()
    assert sorted((str(x["vec_id"]), x["n_links"], str(x["component_id"])) for x in got) == brute(rows)
    assert all(x["kept"] == (x["vec_id"] is not None and x["vec_id"] == x["component_id"]) for x in got)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.cosine_groups(spark, df).count() == 0
