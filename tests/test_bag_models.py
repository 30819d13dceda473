"""Newton solver, forests, passive-aggressive blocks, and saved bag models."""

import json
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from sifter.operators import bag_models as BM
from sifter.operators import csr, dual, forest, lexicon, newton
from sifter.operators import passive_aggressive as PA

SCHEMA = "id long, type string, words map<string,int>"


def articles(n=80, seed=1, words=25):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        shift = 8 * (rnd.random() < 0.85) * (i % 2)
        bag = {}
        for _ in range(rnd.randint(0, 9)):
            w = f"w{rnd.randrange(words) + shift}"
            bag[w] = bag.get(w, 0) + rnd.randint(1, 3)
        rows.append((i, "reliable" if i % 2 else "fake", bag))
    return rows


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(articles(), SCHEMA).cache()


def dense(rows):
    names = sorted({w for _, _, b in rows for w in b})
    x = np.zeros((len(rows), len(names)))
    for i, (_, _, b) in enumerate(rows):
        for w, n in b.items():
            x[i, names.index(w)] = n
    return names, x, np.array([1.0 if t == "reliable" else -1.0 for _, t, _ in rows])


def scores(model, df):
    return {r.id: r.score for r in model.transform(df).collect()}


# --------------------------------------------------------------------- newton


@pytest.mark.parametrize("kind,loss", [("logistic", "logistic"), ("svm", "squared_hinge")])
def test_newton_finds_the_minimum(train, kind, loss):
    model = BM.LinearBag(kind=kind, options='{"C": 2.0}').fit(train)
    names, x, y = dense(articles())
    table = {r.word: r.w for r in model.tables["weights"].collect()}
    w, b = np.array([table.get(n, 0.0) for n in names]), model.facts["bias"]

    def objective(w, b):
        return 0.5 * (w @ w + (kind == "svm") * b * b) + 2.0 * newton.LOSSES[loss](y * (x @ w + b))[0].sum()

    slope = 2.0 * newton.LOSSES[loss](y * (x @ w + b))[1] * y
    assert np.abs(w + x.T @ slope).max() < 1e-6 and abs((kind == "svm") * b + slope.sum()) < 1e-6
    rnd = np.random.RandomState(0)
    for _ in range(50):
        assert objective(w, b) <= objective(w + rnd.randn(len(w)) * 0.01, b + rnd.randn() * 0.01)


def test_svm_finds_which_rows_count_in_few_passes(spark):
    """Rows whose lengths differ by orders of magnitude, most of them separable:
    Newton steps on the weights misjudge which rows count."""
    rnd = np.random.RandomState(5)
    n, dim = 300, 900
    parts = []
    for lo in range(0, n, 100):
        idx, val = [], []
        for _ in range(100):
            some = np.sort(rnd.choice(dim, rnd.choice([5, 40, 200]), replace=False)).astype(np.int32)
            idx.append(some)
            val.append(np.ceil(rnd.pareto(1.0, len(some)) * 2).clip(1, 500))
        ptr = np.append(0, np.cumsum([len(i) for i in idx]))
        parts.append(csr.Block(np.arange(lo, lo + 100), rnd.choice([-1.0, 1.0], 100), ptr, np.concatenate(idx), np.concatenate(val)))
    rows = spark.sparkContext.parallelize(parts, 3).cache()
    problem = newton.Problem("squared_hinge", 1.0, penalised_bias=True)
    looks = []

    def look(w):
        looks.append(np.abs(newton.evaluate(rows, dim, w, problem)[1]).max())
        return looks[-1]

    w = dual.minimise(rows, dim, 1.0, 1e-6, look)
    assert look(w) <= 1e-6 and len(looks) <= 12


def test_losses_have_their_derivatives():
    z, e = np.linspace(-4, 4, 41) + 0.013, 1e-6
    for loss in newton.LOSSES.values():
        assert np.allclose((loss(z + e)[0] - loss(z - e)[0]) / (2 * e), loss(z)[1], atol=1e-5)
        assert np.allclose((loss(z + e)[1] - loss(z - e)[1]) / (2 * e), loss(z)[2], atol=1e-5)


def test_hessian_product_is_the_gradient_s_change(spark, train):
    index = csr.word_index(train).cache()
    blocks = csr.pack(csr.sparse_rows(train, index, F.when(F.col("type") == "reliable", 1.0).otherwise(-1.0)), 3)
    blocks, dim = newton.prepare(blocks), index.count()
    rnd = np.random.RandomState(3)
    theta, v = rnd.randn(dim + 1) * 0.3, rnd.randn(dim + 1)
    problem = newton.Problem("logistic", 0.7)
    e = 1e-6
    up, down = (newton.evaluate(blocks, dim, theta + s * e * v, problem)[1] for s in (1, -1))
    assert np.allclose((up - down) / (2 * e), newton.hessian_times(blocks, dim, theta, v, problem), atol=1e-5)
    # the blocks' inverses: those of 1 + 3 * a block's Hessian, averaged
    expected = np.zeros(dim + 1)
    for r in blocks.collect():
        x = np.zeros((len(r.block), dim + 1))
        x[:, dim] = 1.0
        x[r.block.row(), r.block.idx] = r.block.val
        assert np.allclose(r.products, x @ x.T)
        bend = 0.7 * newton.logistic(r.block.y * (x @ theta))[2]
        expected += np.linalg.solve(np.eye(dim + 1) + 3 * x.T @ (bend[:, None] * x), v) / 3
    assert np.allclose(newton.block_inverses(blocks, dim, theta, v, problem, 3), expected, atol=1e-4)


def test_newton_over_many_blocks(monkeypatch, train):
    one = BM.LinearBag(kind="svm").fit(train)
    monkeypatch.setattr(csr, "BLOCK_ROWS", 9)
    many = BM.LinearBag(kind="svm").fit(train)
    a, b = ({r.word: r.w for r in m.tables["weights"].collect()} for m in (one, many))
    assert max(abs(a.get(k, 0) - b.get(k, 0)) for k in a | b) < 1e-5 and abs(one.facts["bias"] - many.facts["bias"]) < 1e-5


@pytest.mark.parametrize("heavy", [3, 1000])
def test_preconditioner_of_heavy_rows_and_a_diagonal(spark, monkeypatch, train, heavy):
    monkeypatch.setattr(newton, "HEAVY", heavy)
    index = csr.word_index(train).cache()
    table = csr.pack(csr.sparse_rows(train, index, F.when(F.col("type") == "reliable", 1.0).otherwise(-1.0)), 3)
    blocks, dim = csr.load(table), index.count()
    rnd = np.random.RandomState(3)
    theta, v = rnd.randn(dim + 1) * 0.3, rnd.randn(dim + 1)
    problem = newton.Problem("logistic", 0.7, penalised_bias=True)
    xs, ys = [], []
    for b in blocks.collect():
        x = np.zeros((len(b), dim + 1))
        x[:, dim] = 1.0
        x[b.row(), b.idx] = b.val
        xs.append(x)
        ys.append(b.y)
    x, y = np.concatenate(xs), np.concatenate(ys)
    bend = 0.7 * newton.logistic(y * (x @ theta))[2]
    top = np.argsort(-bend * (x ** 2).sum(1))[:heavy]
    rest = np.setdiff1d(np.arange(len(y)), top)
    m = np.eye(dim + 1) + x[top].T @ (bend[top, None] * x[top]) + np.diag((bend[rest, None] * x[rest] ** 2).sum(0))
    got = newton.preconditioner(*newton.curvature(blocks, dim, theta, problem), dim, problem)(v)
    assert np.allclose(got, np.linalg.solve(m, v), atol=1e-5)


def test_newton_needs_few_products_on_long_and_short_texts_in_many_blocks(spark, monkeypatch):
    """Rows of very different lengths and more words than rows, in eight blocks."""
    rnd, rows = np.random.RandomState(5), []
    for i in range(240):
        n = 600 if i % 20 == 0 else 12
        words = np.unique((900 * rnd.rand(n) ** 3).astype(int), return_counts=True)
        rows.append((i, "reliable" if rnd.rand() < 0.6 else "fake", {f"w{w}": int(c) for w, c in zip(*words)}))
    train = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(csr, "BLOCK_ROWS", 30)
    calls, product = [], newton.hessian_times
    monkeypatch.setattr(newton, "hessian_times", lambda *a: calls.append(1) or product(*a))
    model = BM.LinearBag(kind="svm").fit(train)
    assert len(calls) < 400
    names, x, y = dense(rows)
    table = {r.word: r.w for r in model.tables["weights"].collect()}
    w, b = np.array([table.get(n, 0.0) for n in names]), model.facts["bias"]
    slope = newton.squared_hinge(y * (x @ w + b))[1] * y
    assert np.abs(w + x.T @ slope).max() < 1e-5 and abs(b + slope.sum()) < 1e-5


def test_newton_says_if_it_does_not_arrive(train):
    with pytest.raises(ValueError, match="no minimum within 1 steps"):
        BM.LinearBag(kind="logistic", options='{"max_iter": 1}').fit(train)


# -------------------------------------------------------- passive-aggressive


def test_pa_does_not_depend_on_batches_or_partitions(spark, train):
    before = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    seen = []
    try:
        for batch, partitions in (("10000", "2"), ("3", "11")):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            model = BM.LinearBag(kind="pa", options='{"epochs": 6, "partitions": 3}').fit(train.repartition(int(partitions)))
            seen.append(({r.word: r.w for r in model.tables["weights"].collect()}, model.facts["bias"]))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert seen[0] == seen[1] and seen[0][0]


def test_pa_on_one_block_is_the_sequential_algorithm(train):
    names, x, y = dense(articles())
    index = csr.word_index(train).cache()
    rows = csr.sparse_rows(train, index, F.when(F.col("type") == "reliable", 1.0).otherwise(-1.0))
    w, b = PA.PassiveAggressive(epochs=2, partitions=1).weights(rows, index.count())
    number = {r.word: r.idx for r in index.collect()}
    block = next(csr.read_blocks(csr.pack(rows, 1).toArrow().to_batches()))
    own, bias = np.zeros(len(number)), 0.0
    for epoch in range(2):
        for i in np.random.default_rng((42, epoch, int(block.key[0]) & (1 << 63) - 1)).permutation(len(block)):
            at, v = block.idx[block.ptr[i]:block.ptr[i + 1]], block.val[block.ptr[i]:block.ptr[i + 1]]
            short = max(0.0, 1.0 - block.y[i] * (own[at] @ v + bias))
            step = min(1.0, short / (v @ v + 1.0)) * block.y[i]
            own[at] += step * v
            bias += step
    assert np.allclose(w, own, atol=1e-9) and abs(b - bias) < 1e-9
    assert sorted(number) == names


def test_blocks_hold_every_row(train):
    index = csr.word_index(train).cache()
    packed = csr.pack(csr.sparse_rows(train, index, F.lit(1.0)), 5)
    names = {r.idx: r.word for r in index.collect()}
    bags = []
    for block in csr.read_blocks(packed.toArrow().to_batches()):
        for i in range(len(block)):
            at = slice(block.ptr[i], block.ptr[i + 1])
            assert (np.diff(block.idx[at]) > 0).all()
            bags.append({names[j]: int(v) for j, v in zip(block.idx[at], block.val[at])})
    key = lambda b: sorted(b.items())
    assert sorted(map(key, bags)) == sorted(key(b) for _, _, b in articles())
    assert csr.n_rows(packed) == 80 and csr.n_rows(csr.pack(csr.sparse_rows(train.limit(0), index, F.lit(1.0)))) == 0


# ---------------------------------------------------------------------- forest


def brute_trees(block, dim, spec):
    """The same trees by recursion over all rows in memory."""
    bins = np.zeros((len(block), dim), int)
    bins[block.row(), block.idx] = block.val.astype(int)
    base = max(1, int(np.sqrt(dim))) / dim
    out = []

    def leaf_values(rows, w):
        n1 = int(w[rows][block.y[rows] > 0].sum())
        return int(w[rows].sum()) - n1, n1

    trees = forest.Trees(spec.n_trees)
    queue = []
    for t in range(spec.n_trees):
        w = forest.row_weights(spec.seed, t, block.key)
        queue.append((trees.add(t), np.flatnonzero(w > 0), w, 0, 0))
    while queue:
        later = []
        for node, rows, w, depth, draws in queue:
            n0, n1 = leaf_values(rows, w)
            trees.p[node] = n1 / (n0 + n1)
            if len(rows) < spec.min_samples_split or not n0 or not n1 or (spec.max_depth is not None and depth >= spec.max_depth):
                continue
            share = min(1.0, base * 4.0 ** draws)
            best = None
            for f in range(dim):
                if not forest.drawn(forest._keys(spec.seed + 1, np.array([node])), np.array([f]), np.array([share]))[0]:
                    continue
                for cut in sorted(set(bins[rows, f]) - {0}):
                    right = rows[bins[rows, f] >= cut]
                    left = rows[bins[rows, f] < cut]
                    if not len(left):
                        continue
                    (l0, l1), (r0, r1) = leaf_values(left, w), leaf_values(right, w)
                    purity = (r0 * r0 + r1 * r1) / (r0 + r1) + (l0 * l0 + l1 * l1) / (l0 + l1)
                    if best is None or (purity, -f, -cut) > best[0]:
                        best = ((purity, -f, -cut), f, cut, left, right)
            if best is None:
                if share < 1.0:
                    later.append((node, rows, w, depth, draws + 1))
                continue
            _, trees.feature[node], trees.bin[node], left, right = best
            trees.left[node], trees.right[node] = trees.add(trees.tree[node]), trees.add(trees.tree[node])
            for child, part in ((trees.left[node], left), (trees.right[node], right)):
                n0, n1 = leaf_values(part, w)
                trees.p[child] = n1 / (n0 + n1)
                if len(part) >= spec.min_samples_split and n0 and n1 and (spec.max_depth is None or depth + 1 < spec.max_depth):
                    later.append((child, part, w, depth + 1, 0))
        queue = later
    return trees


@pytest.mark.parametrize("spec", [forest.Forest(6, None, 3, 7), forest.Forest(4, 3, 10, 1), forest.Forest(3, None, 2, 5)])
def test_forest_equals_brute_force(train, spec):
    index = csr.word_index(train).cache()
    rows = csr.sparse_rows(train, index, F.when(F.col("type") == "reliable", 1.0).otherwise(-1.0))
    dim = index.count()
    grown = spec.fit(csr.pack(rows, 4), dim)
    block = next(csr.read_blocks(csr.pack(rows, 1).toArrow().to_batches()))
    expected = brute_trees(block, dim, spec)
    for name in ("tree", "feature", "bin", "left", "right", "p"):
        assert getattr(grown, name) == getattr(expected, name), name
    assert len(grown.tree) > 3 * spec.n_trees
    if spec.max_depth is None and spec.min_samples_split == 2:  # grown until every leaf is pure, or nothing splits it
        ends = forest.walk(block, dim, grown.arrays(), spec.n_trees)
        assert ends.shape == (3, 80)


def test_forest_repeats_on_other_partitions(spark, train):
    seen = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            model = BM.ForestBag(options='{"n_trees": 7}').fit(train.repartition(int(partitions)))
            seen.append(scores(model, train))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] and len(seen[0]) == 80


def test_bins():
    from sifter.session import get_spark
    spark = get_spark()
    df = spark.createDataFrame([(float(n),) for n in (1, 31, 32, 33, 34, 35, 64, 10**6)], "n double")
    got = [r.b for r in df.select(forest.count_bin(F.col("n")).alias("b")).collect()]
    assert got == [1, 31, 32, 32, 32, 33, 40, 151]
    df = spark.createDataFrame([(x,) for x in (-1.0, -0.5, 0.0, 0.5, 1.0)], "x double")
    got = [r.b for r in df.select(forest.score_bin(F.col("x")).alias("b")).collect()]
    assert got[0] == 1 and got[2] == 513 and got[4] == 1025 and got == sorted(got)


# ----------------------------------------------------------------- persistence

ESTIMATORS = {
    "linear": BM.LinearBag(kind="logistic"), "svm": BM.LinearBag(kind="svm"),
    "pa": BM.LinearBag(kind="pa", options='{"epochs": 3}'), "multi_nb": BM.LinearBag(kind="multinomial"),
    "compl_nb": BM.LinearBag(kind="complement"), "simple": BM.Lexicon(), "random_forest": BM.ForestBag(options='{"n_trees": 5}')}


@pytest.mark.parametrize("name", ESTIMATORS)
def test_models_are_saved_and_read(train, tmp_path, name):
    model = ESTIMATORS[name].fit(train)
    path = f"{tmp_path}/{name}"
    PipelineModel([model]).write().overwrite().save(path)
    PipelineModel([model]).write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert again.stages[0].uid == model.uid and again.stages[0].facts == model.facts
    new = train.select("id", "words").unionByName(
        train.sparkSession.createDataFrame([(900, {"unheard": 3}), (901, {})], "id long, words map<string,int>"))
    before, after = scores(model, new), scores(again, new)
    assert before == after and len(after) == 82 and all(-1 <= s <= 1 for s in after.values())
    model.save(f"{tmp_path}/alone")
    assert scores(type(model).load(f"{tmp_path}/alone"), new) == before


def test_estimators_are_saved_and_read(tmp_path):
    est = BM.LinearBag(kind="svm", options='{"C": 0.5}')
    est.save(f"{tmp_path}/e")
    again = BM.LinearBag.load(f"{tmp_path}/e")
    assert again.getOrDefault("kind") == "svm" and json.loads(again.getOrDefault("options")) == {"C": 0.5}


def test_columns_can_have_other_names(train):
    named = train.select(F.col("id").alias("doc"), F.col("type").alias("label"), F.col("words").alias("bag"), F.lit(1).alias("id"))
    est = BM.LinearBag(kind="multinomial")
    est._set(idCol="doc", labelCol="label", wordsCol="bag", scoreCol="s")
    got = {r.doc: r.s for r in est.fit(named).transform(named).collect()}
    assert got == scores(BM.LinearBag(kind="multinomial").fit(train), train)


def test_naive_bayes_against_its_formula(train):
    names, x, y = dense(articles())
    for kind in ("multinomial", "complement"):
        raw = []
        for c in (1.0, -1.0):
            own = x[y == c].sum(0) if kind == "multinomial" else x[y != c].sum(0)
            logp = np.log((own + 1) / (own.sum() + len(names)))
            raw.append(x @ logp + np.log((y == c).sum() + 1) if kind == "multinomial" else -(x @ logp))
        expected = np.tanh((raw[0] - raw[1]) / 2)
        got = scores(BM.LinearBag(kind=kind).fit(train), train)
        assert np.allclose([got[i] for i in range(80)], expected)


def test_lexicon_model_scores_as_its_operators(train):
    model = BM.Lexicon().fit(train)
    long = train.select("id", F.explode("words").alias("word", "n"))
    plain = lexicon.score_lexicon(long, model.tables["lexicon"], train)
    assert scores(model, train) == {r.id: r.score for r in plain.collect()}


def test_meta_forest(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, "reliable" if i % 2 else "fake", rnd.uniform(-1, 0.2) + 0.8 * (i % 2), rnd.uniform(-1, 1)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, type string, preds_a double, preds_b double")
    est = BM.ForestTable(columns='["preds_a", "preds_b"]', options='{"n_trees": 15, "max_depth": null, "min_samples_split": 2, "seed": 0}')
    model = est.fit(df)
    model.save(f"{tmp_path}/meta")
    got = scores(model, df)
    assert got == scores(BM.ForestTableModel.load(f"{tmp_path}/meta"), df) and set(got.values()) == {1.0, -1.0}
    assert sum((got[i] > 0) == bool(i % 2) for i in range(120)) > 110
