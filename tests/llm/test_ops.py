"""Each operator against brute force, the public library, or held-out rows; and the odd inputs of every docstring."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import ann, bpe, chat, exact, langid, lines, mix, near, queries, segment, slots, toxic
from tests.conftest import SF, oracle_rows, rows_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None) for i, t, lang, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = "word " * 30_000
    rows = [(1, "a b c d e f g", "en", "s"), (2, "a b  c d\te f g", "en", "s"), (2, "a b  c d\te f g", "en", "s"), (None, "a b c d e f g", None, None), (None, None, None, None), (3, None, "fr", "t"), (4, "", "fr", "t"), (5, " \n\t", None, "t"), (6, long, "en", None), (7, long + "x", "en", "s"), (8, "日本語 テキスト", "ja", "s")]
    df = docs_of(spark, rows)
    clash = "name size key gid node label h k th score slot part copies uid k_ t_ d_ s_ n_ gone_ score_ predicted_ size_ place start whole_text predicted row hash id none times prompt input output messages".split()
    return df.withColumns({c: F.lit(f"user's {c}") for c in clash})


def kept_as_they_are(out, odd, changed=("text",)):
    """All columns of the user are there with their values."""
    assert out.columns[: len(odd.columns)] == odd.columns or set(odd.columns) <= set(out.columns)
    for r in out.collect():
        assert all(r[c] == f"user's {c}" for c in odd.columns if c not in DOCS and c not in changed)
    return out


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def some(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(k for k in queries.ORACLES))
def test_oracle(spark, duck, name):
    assert rows_of(queries.QUERIES[name](spark, SF)) == oracle_rows(duck, queries.ORACLES[name])


# 1 language
def test_language_of_held_out_rows(some):
    rows = langid.predict_documents(some).collect()
    truth = {r.doc_id: r.lang for r in some.select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == some.count() and {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.9


def test_language_spans_and_odd_inputs(spark, some, odd, none):
    model = langid.fit(some)
    en, fr = (" ".join(r.text for r in some.filter(f"lang = '{x}' AND length(text) < 600").limit(2).collect()) for x in ("en", "fr"))
    lang, score, spans = model.predict([en + " " + fr, "", "12 + 3"])
    assert {x for x, _ in spans[0]} >= {"en", "fr"} and lang[1:] == ["und", "und"] and list(score[1:]) == [0, 0]
    got = {r.doc_id: r for r in langid.predict_documents(odd).collect()}
    assert got[3].lang_pred == "und" and got[8].lang_pred == "ja" and 0 <= got[6].score <= 1
    assert langid.predict_documents(none).count() == 0


def model_of(texts):
    import pyarrow as pa

    langs = sorted(texts)
    batch = pa.RecordBatch.from_arrays([pa.array([texts[x] for x in langs]), pa.array(langs)], names=["text", "lang"])
    return langid.Model.of(langs, pa.Table.from_batches(langid._learn([batch])))


def test_viterbi_is_the_best_path():
    """Against all paths, for several documents side by side."""
    import itertools

    rng = np.random.default_rng(5)
    for penalty in (0.5, 2.0, 6.0):
        model = langid.Model(["a", "b", "c"], np.ones((3, 1 << segment.TRIGRAM_BITS)), np.ones((3, len(langid.NAMES))), penalty)
        n = [5, 1, 0, 7, 3]
        doc = np.repeat(np.arange(5), n)
        score = rng.normal(0, 3, (len(doc), 3)).astype(np.float32)
        label = model.path(score, doc, 5)
        for d in range(5):
            s, own = score[doc == d].astype(float), label[doc == d]
            value = lambda p, s=s: sum(s[t, x] for t, x in enumerate(p)) - penalty * sum(x != y for x, y in itertools.pairwise(p))
            best = max((value(p) for p in itertools.product(range(3), repeat=len(s))), default=0)
            assert abs(value(own) - best) < 1e-3


def test_short_passages_in_another_script_are_spans():
    rng = random.Random(1)
    letters = {"en": "abcdefghilmnoprstuw", "fr": "abcdeéèfgilmnopqrstuvz", "ru": "абвгдежзиклмнопрст", "el": "αβγδεζηθικλμνοπρστ", "ar": "ابتثجحخدذرزسشصضطظعغ"}
    vocab = {x: ["".join(rng.choice(c) for _ in range(6)) for _ in range(300)] for x, c in letters.items()}
    said = lambda x, n: [rng.choice(vocab[x]) for _ in range(n)]
    model = model_of({x: " ".join(said(x, 4000)) for x in letters})
    for x in ("ru", "el", "ar"):
        lang, score, spans = model.predict([" ".join(said("en", 100) + said(x, 10) + said("en", 90))])
        assert lang == ["en"] and spans == [[("en", 100), (x, 10), ("en", 90)]] and abs(score[0] - 0.95) < 1e-9
    # A letter, and a script of no language, are no spans.
    lang, score, spans = model.predict([" ".join(said("en", 50) + ["μ"] + said("en", 50)), " ".join(said("en", 50) + ["ภาษา"] * 3 + said("en", 50)), "ภาษา"])
    assert spans[:2] == [[("en", 101)], [("en", sum(n for _, n in spans[1]))]] and list(score[:2]) == [1, 1] and lang[2] in letters


def test_two_hundred_languages():
    rng = random.Random(2)
    vocab = {f"x{k:03}": ["".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(7)) for _ in range(12)] for k in range(200)}
    model = model_of({x: " ".join(rng.choice(v) for _ in range(200)) for x, v in vocab.items()})
    names = ["x199", "x000", "x150", "x128", "x127", "x003", "x144"]
    lang, score, spans = model.predict([" ".join(rng.choice(vocab[x]) for _ in range(20)) for x in names])
    assert lang == names and list(score) == [1] * 7 and spans == [[(x, 20)] for x in names]


# 2 mixing
def brute_targets(size, weights=(5, 2, 1), most=3):
    names = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(most * size[s] for s in capped)
        t = {s: most * size[s] if s in capped else left * w[s] / sum(w[x] for x in open_) for s in names}
        over = {s for s in open_ if t[s] > most * size[s] * (1 + 1e-12)}
        if not over:
            return t
        capped |= over


def test_mix_meets_its_targets(some):
    some = some.withColumn("source", F.when(F.col("doc_id") % 9 == 0, F.lit(None)).when(F.col("doc_id") % 50 == 1, "a small one").otherwise(F.col("source")))
    rows = mix.mix(some).collect()
    texts = Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in some.collect())
    assert Counter((r.doc_id, r.size) for r in rows) == texts
    size, taken = Counter(), Counter()
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    for s, t in brute_targets(size).items():
        assert abs(taken[s] - t) <= max(0.05 * t, max(r.size for r in rows if r.source == s)), s
    assert all(abs(r.target - brute_targets(size)[r.source]) < 1e-6 * (1 + r.target) and r.source_size == size[r.source] for r in rows)
    again = mix.mix(some.repartition(7)).collect()
    assert {r.doc_id: r.taken for r in rows} == {r.doc_id: r.taken for r in again}


def test_pivot_keeps_words_and_means():
    rng = np.random.default_rng(1)
    for _ in range(50):
        sa, sb, a, b = *rng.integers(1, 9, 2).astype(float), *rng.random(2)
        ends = [mix.pivot(sa, a, sb, b, u) for u in (0.0, 1.0)]
        for x, y in ends:
            assert abs(sa * x + sb * y - sa * a - sb * b) < 1e-6 and (x in (0, 1) or y in (0, 1)) and -1e-9 <= min(x, y) and max(x, y) <= 1 + 1e-9
        draws = np.array([mix.pivot(sa, a, sb, b, u) for u in (np.arange(2000) + 0.5) / 2000])
        assert abs(draws[:, 0].mean() - a) < 2e-3


def test_mix_odd_inputs(odd, none):
    rows = mix.mix(odd).collect()
    assert len(rows) == odd.count() and mix.mix(none).count() == 0
    assert all(r.taken == 0 for r in rows if not r.size)
    assert kept_as_they_are(mix.mixed(odd), odd).columns == odd.columns


def test_every_document_keeps_its_expected_copies(spark):
    """Folds that are small and skewed, and a whole mix of many folds: means over seeds are the fractions."""
    import pandas as pd

    sizes = [5000, 4000, 3000, 20, 15, 10, 5]
    rows = pd.DataFrame({"doc_id": range(7), "h": np.arange(7) * 7919, "size": sizes, "part": [0.3] * 7})
    first = np.array([mix._fold(0, s)(rows).sort_values("doc_id")["part"] for s in range(6000)])
    assert np.abs(first.mean(0) - 0.3).max() < 0.025 and np.abs(first @ sizes - 0.3 * sum(sizes)).max() < 1e-6
    assert (((first > 0) & (first < 1)).sum(1) <= 1).all()
    rows["part"] = [0.3, 0.9, 0.5, 0.1, 0.7, 0.2, 0.6]
    later = np.array([mix._fold(2, s)(rows).sort_values("doc_id")["part"] for s in range(6000)])
    assert np.abs(later.mean(0) - rows["part"]).max() < 0.025 and np.abs(later @ sizes - rows["part"] @ sizes).max() < 1e-6


def test_means_of_a_whole_mix(spark, monkeypatch):
    monkeypatch.setattr(mix, "CHUNK", 6)
    monkeypatch.setattr(mix, "FAN", 2)
    rng = random.Random(3)
    docs = docs_of(spark, [(i, "w " * rng.choice((1, 2, 3, 50, 400)), "en", s) for s, n in (("a", 18), ("b", 30)) for i in range(100 * n, 101 * n)]).coalesce(1)
    seen = Counter()
    draws = 24
    for s in range(draws):
        rows = mix.mix(docs, weights=(1, 2), seed=s).collect()
        for r in rows:
            seen[r.doc_id] += r.copies
    of = {r.doc_id: r.target / r.source_size for r in rows}
    z = np.array([(seen[d] / draws - c) / np.sqrt(max((c % 1) * (1 - c % 1), 1e-3) / draws) for d, c in of.items()])
    assert abs(z).max() < 4.5 and abs(z.mean()) < 0.5 and (z**2).mean() < 2


def test_rows_there_many_times_are_mixed_as_one(spark):
    docs = docs_of(spark, [(1, "a b", "en", "s")] * 70 + [(None, "c d e", "en", "s")] * 7 + [(k, "x " * k, "en", "t") for k in range(2, 40)])
    rows = mix.mix(docs).collect()
    same = [r.copies for r in rows if r.doc_id == 1]
    assert len(rows) == docs.count() and len(same) == 70 and max(same) - min(same) <= 1 and max(r.copies for r in rows) <= 3
    assert Counter(r.doc_id for r in mix.mixed(docs).collect()) == {d: n for d, n in ((d, sum(r.copies for r in rows if r.doc_id == d)) for d in {r.doc_id for r in rows}) if n}


# 3 near duplicates
def brute_classes(texts, threshold=0.8):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t or "")
        if w:
            sets[i] = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
    up = {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a].keys() & sets[b].keys():
                wa, wb = ({x: 1 + np.log(n) for x, n in sets[i].items()} for i in (a, b))
                least = sum(min(wa[x], wb[x]) for x in wa.keys() & wb.keys())
                if least / (sum(wa.values()) + sum(wb.values()) - least) >= threshold:
                    up[find(a)] = find(b)
    groups = defaultdict(list)
    for i in texts:
        groups[find(i)].append(i)
    return {i: min(g) for g in groups.values() for i in g}


def test_near_classes_are_those_of_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(500)]
    texts = {}
    for f in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice((3, 40, 120)))]
        for v in range(6):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 30)) if len(words) > 5 else v):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            texts[f * 10 + v] = " ".join(words)
    # Away from the threshold, where the damped document frequencies may decide otherwise.
    low, high = brute_classes(texts, 0.84), brute_classes(texts, 0.74)
    got = {r.doc_id: r for r in near.near_classes(docs_of(spark, [(i, t, "en", "s") for i, t in texts.items()])).collect()}
    for i in texts:
        for j in texts:
            if low[i] == low[j]:
                assert got[i].class_id == got[j].class_id
            if got[i].class_id == got[j].class_id:
                assert high[i] == high[j]
    size = Counter(r.class_id for r in got.values())
    assert all(r.class_size == size[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got.values())


def test_later_rounds_and_document_frequencies(spark):
    """One bucket of hundreds of near copies whose links are few and far from its pivots, against brute force with the operator's own weights."""
    rng = random.Random(6)
    base = [f"b{k}" for k in range(160)]
    texts = {}
    for i in range(260):
        words = list(base)
        for _ in range(rng.choice((1, 2, 3, 4, 6))):
            words[rng.randrange(160)] = f"x{i}{rng.random()}"
        texts[i] = " ".join(words)
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in texts.items()])
    for damp, deviations in ((near.DAMP, None), (0.9, near.DEVIATIONS)):
        weights = near.weight_table(docs, damp)
        sampler, sets = near.Sampler(weights), []
        for t in texts.values():
            _, ids, times = near.shingle_sets([t])
            sets.append((ids, sampler.of(ids, times)))
        up = list(range(260))

        def find(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for a in range(260):
            for b in range(a):
                if near.similarity(*sets[a], *sets[b]) >= near.SIMILARITY:
                    up[find(a)] = find(b)
        groups = defaultdict(set)
        for i in range(260):
            groups[find(i)].add(i)
        got = defaultdict(set)
        for r in near.near_classes(docs, damp=damp, deviations=deviations).collect():
            got[r.class_id].add(r.doc_id)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values())), (damp, deviations)


def test_near_odd_inputs(odd, none):
    rows = near.near_classes(odd).collect()
    assert len(rows) == odd.count() and near.near_classes(none).count() == 0
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    assert {r.class_id for d in (1, 2) for r in of[d]} == {1} and sum(r.kept for d in (1, 2) for r in of[d]) == 1
    assert of[6][0].class_id == of[7][0].class_id == 6 and all(of[d][0].class_size == 1 for d in (3, 4, 5))
    kept = kept_as_they_are(near.deduplicated(odd), odd)
    assert kept.columns == odd.columns and 2 not in {r.doc_id for r in kept.collect()}


def test_sampling_agrees_with_weighted_jaccard():
    sampler = near.Sampler(np.ones(near.BUCKETS, np.float32))
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 1 << near.ID_BITS, 400).astype(np.uint64)
    wa, wb = rng.uniform(0.5, 3, 300), None
    wb = np.concatenate((wa[100:] * rng.choice((1, 0.8), 200), rng.uniform(0.5, 3, 100)))
    owner = np.repeat((0, 1), 300)
    _, s = sampler.samples(owner, np.concatenate((ids[:300], ids[100:])), np.concatenate((wa, wb)), 0, near.SAMPLES + near.SKETCH)
    least = np.minimum(wa[100:], wb[:200]).sum()
    assert abs((s[0] == s[1]).mean() - least / (wa.sum() + wb.sum() - least)) < 0.06


# 4 chat
def test_chat_reads_back_what_it_wrote(spark):
    texts = ["\\### Assistant: </turn> ok", "<turn:user>x</turn>\n", "\\b\\l\\g", "", None, "a\nb", "🙂<>"]
    turns = spark.createDataFrame([(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(texts)] + [(None, None, None, None), (2, 0, "r<o>\\l", "x")], "conv_id long, turn long, role string, text string")
    turns = turns.withColumn("segment", F.lit("clash"))
    formatted = chat.format_turns(chat.canonical_turns(turns))
    for r in formatted.collect():
        role, text = map(chat.unescape, chat.TURN.fullmatch(r.segment).groups())
        assert (role, text) == (r.role, r.text)
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    full = "".join(f"{'assistant' if k % 2 else 'user'}\n{t or ''}\n" for k, t in enumerate(texts))
    said = "".join(t or "" for t in texts[1::2])
    assert got[1].turns_sha256 == hashlib.sha256(full.encode()).hexdigest() and got[1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[1].loss_chars == len(said) and got[None].n_turns == 1 and got[2].loss_chars == 0
    assert chat.digests(formatted.limit(0)).count() == 0


def test_layouts_become_turns(spark):
    rows = [
        ("a", '{"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ho"}]}'), ("b", '{"prompt": "p", "response": "r"}'), ("c", '{"instruction": "do", "input": "it", "output": "done"}'),
        ("d", '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "z"}]}'), ("e", '{"data": {"system": "s", "turns": [{"speaker": "bot", "text": "t"}]}}'), ("f", "no json"), ("g", None), ("h", '{"x": 1}'),
    ]
    out = chat.canonical_json(spark.createDataFrame(rows, "id string, record string")).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.conv_id, r.turn or 0)):
        got[r.conv_id].append((r.role, r.text))
    assert got["a"] == [("user", "hi"), ("assistant", "ho")] and got["b"] == [("user", "p"), ("assistant", "r")] and got["c"] == [("user", "do\n\nit"), ("assistant", "done")]
    assert got["d"] == [("user", "q"), ("assistant", "z")] and got["e"] == [("system", "s"), ("assistant", "t")]
    assert all(got[k] == [(None, None)] for k in "fgh")
    typed = spark.createDataFrame([("1", "p", None)], "id string, prompt string, response string")
    assert [(r.role, r.text) for r in chat.canonical_turns(typed).collect()] == [("user", "p"), ("assistant", "")]
    with pytest.raises(ValueError, match="layout"):
        chat.mapping_of(spark.createDataFrame([(1,)], "odd int"))


def test_layouts_with_extra_fields(spark):
    turns = '{"role": "user", "content": "hi", "name": "x"}, {"role": "assistant", "content": "ho"}'
    rows = [
        ("a", f'{{"id": 7, "source": {{"url": ["u"]}}, "messages": [{turns}]}}'), ("b", '{"prompt": "p", "response": "r", "score": 0.5}'), ("c", '{"instruction": "do", "input": "it", "output": "done", "prompt": "no", "n": [1]}'),
        ("d", '{"conv_id": "k", "turn": 3, "role": "user", "text": "t", "input": "no"}'), ("e", '{"messages": [], "id": 1}'), ("f", '{"prompt": "p", "response": null, "messages": null}'),
        ("g", '{"messages": ["x"]}'), ("h", '{"data": {"system": "s", "turns": [], "x": 1}}'), ("i", f'{{"messages": [{turns}], "prompt": "p", "response": "r"}}'), ("j", '{"prompt": {"a": 1}, "response": "r"}'), ("k", '[1]'),
    ]
    got = defaultdict(list)
    for r in sorted(chat.canonical_json(spark.createDataFrame(rows, "id string, record string")).collect(), key=lambda r: (r.conv_id, r.turn or 0)):
        got[r.conv_id].append((r.layout, r.turn, r.role, r.text))
    messages = [("messages", 0, "user", "hi"), ("messages", 1, "assistant", "ho")]
    assert got["a"] == got["i"] == messages and [x[2:] for x in got["b"]] == [("user", "p"), ("assistant", "r")] and [x[2:] for x in got["c"]] == [("user", "do\n\nit"), ("assistant", "done")]
    assert got["k"][0] in [("rows by turn", 3, "user", "t"), (None,) * 4] and ("rows by turn", 3, "user", "t") in got["k"] and (None,) * 4 in got["k"]
    assert got["e"] == [("messages", None, None, None)] and [x[2:] for x in got["f"]] == [("user", "p"), ("assistant", "")] and got["h"] == [("nested dialogue", 0, "system", "s")]
    assert got["g"] == got["j"] == [(None,) * 4] and "d" not in got
    typed = spark.createDataFrame([(1, 0, "user", "t", "i", "p")], "conv_id long, turn long, role string, text string, input string, prompt string")
    assert [tuple(r) for r in chat.canonical_turns(typed).collect()] == [(1, 0, "user", "t")]


# 5 toxicity
def test_gradients_are_right():
    g, net = np.random.default_rng(0), toxic.Net(1)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    idx = g.integers(-1, 6, (5, toxic.WINDOW))
    idx[:, 0] = np.maximum(idx[:, 0], 0)
    x, y = g.standard_normal((6, toxic.D)), np.array([0, 1, 1, 0, 1.0])

    def loss():
        z = net._forward(idx, net.projected(x, "f"), net.projected(x, "b"))[0].astype(float)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    grads, dx = net.gradients(idx, x, y)
    for k in ("w", "v", "Wa", "Uf", "Wb", "cf"):
        i = tuple(s - 1 for s in net.p[k].shape)
        net.p[k][i] += 1e-3
        up = loss()
        net.p[k][i] -= 2e-3
        down = loss()
        net.p[k][i] += 1e-3
        assert abs((up - down) / 2e-3 - grads[k][i]) < 1e-4, k


def test_forward_pass_by_hand():
    """The network word by word in plain Python: gates, both directions, attention, padding."""
    net, g = toxic.Net(3), np.random.default_rng(8)
    x = g.standard_normal((5, toxic.D)).astype(np.float32)
    sig = lambda v: 1 / (1 + np.exp(-v))
    H = toxic.H
    idx = np.full((3, toxic.WINDOW), -1)
    for i, n in enumerate((toxic.WINDOW, 4, 1)):
        idx[i, :n] = g.integers(0, 5, n)
    got = net._forward(idx, net.projected(x, "f"), net.projected(x, "b"))[0]
    for i in range(3):
        words = [w for w in idx[i] if w >= 0]
        states = {}
        for d, order in (("f", range(len(words))), ("b", range(len(words) - 1, -1, -1))):
            h = np.zeros(H)
            for t in order:
                a, b = x[words[t]] @ net.p[f"W{d}"] + net.p[f"c{d}"], h @ net.p[f"U{d}"]
                z, r = sig(a[:H] + b[:H]), sig(a[H : 2 * H] + b[H : 2 * H])
                h = z * h + (1 - z) * np.tanh(a[2 * H :] + r * b[2 * H :])
                states[d, t] = h
        hs = np.array([np.concatenate((states["f", t], states["b", t])) for t in range(len(words))])
        e = np.exp(np.tanh(hs @ net.p["Wa"] + net.p["ba"]) @ net.p["v"])
        assert abs((e / e.sum()) @ hs @ net.p["w"] + net.p["b"][0] - got[i]) < 1e-4


def test_toxic_words_are_learned():
    rng = random.Random(4)
    vocab, bad = ["the", "of", "and", *("".join(rng.choice("aeioulnrst") for _ in range(6)) for _ in range(300))], ["vileword", "nastyone"]
    clean = [" ".join(rng.choice(vocab) for _ in range(rng.choice((20, 90)))) for _ in range(240)]
    foul = [t.split() for t in clean[:80]]
    for t in foul:
        t[rng.randrange(len(t))] = rng.choice(bad).upper()
    foul = [" ".join(t) for t in foul]
    net = toxic.train(foul[:60] + clean[80:200], np.array([1] * 60 + [0] * 120))
    assert (toxic.score(net, foul[60:]) >= 0.5).mean() > 0.9 and (toxic.score(net, clean[200:]) >= 0.5).mean() < 0.1
    assert list(toxic.score(net, ["", "123"])) == [0, 0] and toxic.train(clean, np.zeros(240)) is None


def test_toxicity_odd_inputs(spark, odd, none):
    labels = spark.createDataFrame([(1, 0, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    rows = toxic.score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(r.score == 0 and r.predicted == 0 for r in rows)
    assert toxic.score_documents(none, labels).count() == 0 and kept_as_they_are(toxic.clean(odd, labels), odd).columns == odd.columns


def test_toxicity_is_learned_from_long_documents(spark):
    rng = random.Random(9)
    vocab = ["".join(rng.choice("aeioulnrst") for _ in range(6)) for _ in range(200)]
    texts = [" ".join(rng.choice(vocab) for _ in range(1800 if i % 2 else 40)) for i in range(120)]
    foul = {i: " ".join("vileword" if k % 30 == 7 else w for k, w in enumerate(texts[i].split())) for i in range(1, 120, 4)}
    rows = [(i, foul.get(i, t), "en", "s") for i, t in enumerate(texts)]
    assert all(len(t) > 10_000 for t in foul.values())
    labels = spark.createDataFrame([(i, 0, int(i in foul)) for i in range(120)] + [(i, 0, 0) for i in range(500, 600)], "doc_id long, quality int, toxic int")
    got = toxic.score_documents(docs_of(spark, rows + rows[:9]), labels).collect()
    assert len(got) == 129 and np.mean([r.predicted == (r.doc_id in foul) for r in got]) > 0.95


# 6 byte pairs
def test_bpe_equals_the_library(some):
    from tokenizers import Tokenizer

    t, codec = Tokenizer.from_file(bpe.default_path()), bpe.Codec(bpe.default_path(), cache=500)
    rng = random.Random(1)
    parts = ["a", "b", "'", "s", "é", " ", "  ", "\n", "\t", "\r", "　", "日", "🙂", "1", ".", "<|endoftext|>", "q", "z", "\x85", "\x1c", "’", "\u00a0", "\u2003", "\u2028", "п", "ш", "ع", "ك", "த", "ி", "ʼ", "ll", "ve", "re", "_", "}", "\x7f", "٣", "½"]
    texts = ["", "\n\nb", *("".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)), *(r.text for r in some.limit(60).collect())]
    for x in texts:
        ids = t.encode(x, add_special_tokens=False).ids
        assert codec.encode(x) == ids and codec.decode(ids) == t.decode(ids, skip_special_tokens=False) == x


def test_cuts_in_all_scripts():
    codec = bpe.Codec(bpe.default_path())
    for text in ("ъыьэюяшщъыьэюя", "கணினிமொழி", "日本語処理", "\u1234\u1235\u1236"):
        found = codec.fragments(text.encode())
        assert len(found) > 1 and b"".join(found) == text.encode() and all(f.decode() for f in found)


def test_bpe_refuses_what_it_does_not_cover(tmp_path):
    import json

    spec = json.load(open(bpe.default_path()))
    for change in ({"normalizer": {"type": "NFC"}}, {"added_tokens": [dict(spec["added_tokens"][0], lstrip=True)]}, {"model": spec["model"] | {"merges": spec["model"]["merges"][::-1]}}):
        path = tmp_path / "x.json"
        path.write_text(json.dumps(spec | change))
        with pytest.raises(ValueError, match="vocabulary file"):
            bpe.Codec(str(path))


def test_bpe_odd_inputs(odd, none):
    rows = bpe.encode_documents(odd, keep_ids=True).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == odd.count() and all((r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) == (0, empty, empty, []) for r in rows if r.doc_id in (3, 4))
    assert all(r.n_tokens == len(r.ids) for r in rows) and bpe.encode_documents(none).count() == 0


# 7 exact copies
def test_exact_groups_by_small_blocks(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.randrange(40))) for _ in range(300)]
    rows = exact.exact_groups(docs_of(spark, [(i, t, "", "") for i, t in enumerate(texts)]).repartition(5), block=3).collect()
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t) for t in texts]
    first, size = {}, Counter(norm)
    for i, t in enumerate(norm):
        first.setdefault(t, i)
    assert len(rows) == 300
    for r in rows:
        t = norm[r.doc_id]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (first[t], size[t], first[t] == r.doc_id, hashlib.sha256(t.encode()).hexdigest())


def test_exact_odd_inputs(odd, none):
    rows = exact.exact_groups(odd).collect()
    assert len(rows) == odd.count() and exact.exact_groups(none).count() == 0
    group = [r for r in rows if r.doc_id in (1, 2)]
    assert {(r.keep_id, r.group_size) for r in group} == {(1, 4)} and sum(r.kept for r in group) == 1
    assert {(r.keep_id, r.group_size) for r in rows if r.doc_id in (3, 4)} == {(3, 3)}
    out = kept_as_they_are(exact.deduplicated(odd), odd)
    assert out.columns == odd.columns and sorted(r.doc_id for r in out.collect()) == [1, 3, 5, 6, 7, 8]


def test_rows_that_differ_elsewhere_are_kept_by_value(spark):
    rows = docs_of(spark, [(i, f"text {i} of six words here", lang, s) for i in (None, -1, 5) for lang in ("en", "fr") for s in "ab"]).withColumn("extra", F.create_map(F.lit("a"), F.col("lang")))
    for f in (exact.deduplicated, near.deduplicated):
        got = [{(r.doc_id, r.lang, r.source) for r in f(x).collect()} for x in (rows.coalesce(1), rows.repartition(5), rows.orderBy(F.desc("source"), F.desc("lang")))]
        assert got[0] == got[1] == got[2] and sorted(str(d) for d, _, _ in got[0]) == ["-1", "5", "None"]


# 8 shards
def test_shards(odd, none, some):
    import xxhash

    rows = slots.shard_documents(some, 40).collect()
    texts = {r.doc_id: r.text for r in some.collect()}
    now, then = slots.slot_map(40), slots.slot_map(41)
    by = defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        h = xxhash.xxh64_intdigest(str(r.doc_id).encode(), seed=42)
        slot = (h - (1 << 64) if h >> 63 else h) % slots.N_SLOTS
        assert (r.size, r.text_crc32, r.virtual_slot, r.shard, r.grown_shard) == (len(data) + 16, zlib.crc32(data), slot, now[slot], then[slot])
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(rows) == len(texts)
    assert all(b in (a, 40) for a, b in zip(now, then, strict=True)) and max(Counter(then).values()) - min(Counter(then).values()) <= 40
    got = slots.shard_documents(odd, 3).collect()
    assert len(got) == odd.count() and slots.shard_documents(none).count() == 0 and {r.size for r in got if r.doc_id in (3, 4)} == {16}


def test_stored_maps_are_edited_by_bytes(spark, some, tmp_path):
    path, key = str(tmp_path / "map"), F.col("doc_id").cast("string")
    slots.store_map(spark, path, 1, slots.slot_map(5, 64))
    rows = some.select("doc_id", F.when(F.pmod(F.xxhash64(key), F.lit(64)) < 12, 9000).otherwise(10).cast("long").alias("size"))
    version = slots.rebalanced(rows, key, F.col("size"), path)
    assert version == 2 and slots.stored_map(spark, path, 1)[1] == slots.slot_map(5, 64)
    now = slots.stored_map(spark, path)[1]
    out = slots.shard(rows, key, F.col("size"), [F.col("doc_id")], 5, 64, now).collect()
    load, before = Counter(), Counter()
    for r in out:
        load[r.shard] += r.size
        before[slots.slot_map(5, 64)[r.virtual_slot]] += r.size
    assert all(r.shard == now[r.virtual_slot] == r.balanced_shard for r in out) and max(load.values()) < max(before.values()) and len(out) == rows.count()
    user = some.select("doc_id", *[F.lit(f"user's {c}").alias(c) for c in ("start", "place", "slot", "shard", "x")])
    got = slots.shard(user, key, F.lit(1), [F.col("doc_id")], 3)
    assert all((r.start, r.place, r.x) == ("user's start", "user's place", "user's x") and 0 <= r.shard < 3 for r in got.collect())


def test_rebalancing_moves_few_slots():
    rng = random.Random(6)
    now = slots.slot_map(5, 200)
    sizes = {s: rng.randrange(1, 100) * (4 if now[s] == 2 else 1) for s in range(200)}
    out = slots.rebalance(now, sizes)
    load = Counter()
    for s, k in enumerate(out):
        load[k] += sizes[s]
    assert max(load.values()) <= 1.05 * sum(load.values()) / 5 and sum(a != b for a, b in zip(now, out, strict=True)) < 80


# 9 neighbours
def test_neighbours(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    bad = [(900001, None, 0), (900020, [0.0] * 64, 0), (900040, [float("nan")] + [1.0] * 63, 0), (900060, [None] + [1.0] * 63, 0), (900080, [1.0, 2.0], 0), (None, [1.0] * 64, 0)]
    same = [(900100 + k, [1.0] * 64, 0) for k in range(60)]
    df = spark.createDataFrame([tuple(r) for r in rows] + bad + same, "vec_id long, embedding array<float>, label int")
    got = defaultdict(list)
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    good = [tuple(r) for r in rows] + same
    ids, x = np.array([r[0] for r in good]), np.array([r[1] for r in good], np.float32).astype(float)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = (x * x[q]).sum(1)
        order = np.lexsort((ids, -s))
        order = order[ids[order] != ids[q]][:20]
        mine = got.pop(ids[q])
        assert all(abs(v - s[np.flatnonzero(ids == i)[0]]) < 1e-12 for i, v in mine) and mine == sorted(mine, key=lambda m: (-m[1], m[0]))
        hits, total = hits + len({i for i, _ in mine} & set(ids[order].tolist())), total + len(order)
        if ids[q] == 900100:
            assert [i for i, _ in mine] == list(range(900101, 900121))
    assert hits / total >= 0.9 and not got
    assert ann.nearest(df.limit(0)).count() == 0 and ann.nearest(df.filter("vec_id IN (900100, 900101)")).count() == 1


def test_neighbours_of_repeated_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(20 * (k % 3), rng.standard_normal(6).tolist(), 0) for k in range(9)] + [(7, [1.0] * 6, 0)] * 3 + [(40, [2.0] * 6, 0)] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    distinct = {(i, tuple(v)) for i, v, _ in rows if i % 20 == 0}
    want = []
    for i, v in distinct:
        others = list(rows)
        others.remove((i, list(v), 0))
        scored = sorted(((-float((np.array(x) * np.array(v)).sum()), j) for j, x, _ in others))[:5]
        want += [(i, r + 1, j, round(-s, 9)) for r, (s, j) in enumerate(scored)]
    for exact in (True, False):
        got = [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in ann.nearest(df, 5, exact=exact).collect()]
        assert sorted(got) == sorted(want)
    one = spark.createDataFrame([(20, [float(k % 50), 1.0], 0) for k in range(300)], "vec_id long, embedding array<double>, label int")
    assert ann.nearest(one, 3).groupBy("query_id").count().first()["count"] == 150


# 10 lines
def brute_lines(docs, least):
    seen, gone = set(), set()
    seqs = [[(n, x.strip(" \t\x0b\x0c\r")) for n, x in enumerate((t or "").split("\n")) if x.strip(" \t\x0b\x0c\r")] for _, t in docs]
    for (i, _), seq in zip(docs, seqs, strict=True):
        for a in range(len(seq)):
            total = 0
            for b in range(a, len(seq)):
                total += len(WORD.findall(seq[b][1]))
                if total >= least:
                    key = tuple(x for _, x in seq[a : b + 1])
                    if key in seen:
                        gone.update((i, seq[k][0]) for k in range(a, b + 1))
                    seen.add(key)
    return gone


@pytest.mark.parametrize("least", [1, 6, 13])
def test_lines_are_those_of_brute_force(spark, least):
    rng = random.Random(least)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 7))) for _ in range(9)]
    docs = [(i, "\n".join(rng.choice([*pool, "", f"own {i} {rng.random()}"]) for _ in range(rng.randrange(14)))) for i in range(40)]
    rows = lines.digests(docs_of(spark, [(i, t, "", "") for i, t in docs]), least).collect()
    gone = {(r.doc_id, n) for r in rows for n in r.removed_lines}
    assert gone == brute_lines(docs, least)
    for r in rows:
        kept = "\n".join(x for n, x in enumerate(docs[r.doc_id][1].split("\n")) if n not in r.removed_lines)
        assert r.text == kept and r.clean_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_runs_of_many_lines_in_repeated_rows(spark):
    rng = random.Random(8)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 4))) for _ in range(6)]
    texts = ["\n".join(rng.choice([*pool, *pool, "", f"own {i}"]) for _ in range(14)) for i in range(24)]
    three = "\n".join(" ".join(f"{x}{k}" for k in range(20)) for x in "abc")
    ids = [None if i < 4 else i for i in range(24)]
    docs = [*zip(ids, texts, strict=True), (50, three), (51, "own a\n" + three), (None, "own b\n" + three + "\nown c")]
    rows = docs_of(spark, [(i, t, "", "") for i, t in docs + docs[::2] + docs[-3:] + docs[:3]])
    key = {t: k for k, (_, t) in enumerate(docs)}
    assert len(key) == len(docs)
    for least in (6, 13, 50):
        # Null ids go first, in order of their texts' hashes.
        th = {r.text: r.th for r in rows.select("text", F.xxhash64("text").alias("th")).collect()}
        once = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, th[d[1]]))
        gone = {(key[once[i][1]], n) for i, n in brute_lines([(i, t) for i, (_, t) in enumerate(once)], least)}
        got = lines.repeated_lines(rows, least).collect()
        text = {h: t for t, h in th.items()}
        assert sorted((key[text[r.th]], n) for r in got for n in r.raw) == sorted(gone)
        assert lines.digests(rows, least).count() == rows.count()


def test_folds_of_the_suffix_array_meet(spark, monkeypatch):
    """Long runs, nested and overlapping, in an array of many folds and levels."""
    monkeypatch.setattr(lines, "CHUNK", 5)
    monkeypatch.setattr(lines, "FAN", 3)
    rng = random.Random(12)
    base = [f"{rng.choice('abc')} line {k % 90}" for k in range(180)]
    docs = [(0, "\n".join(base)), (1, "\n".join(["x1", *base[20:150], "y1", *base[40:50]])), (2, "\n".join([*base[60:100], *base[60:100], "same"])), (3, "\n".join(["same"] * 9)), (4, "\n".join(["own", *["same"] * 20])), (5, "\n".join(base[100:] + base[:30]))]
    for least in (5, 30, 120):
        got = lines.repeated_lines(docs_of(spark, [(i, t, "", "") for i, t in docs]).repartition(3), least).collect()
        assert sorted((r.k, n) for r in got for n in r.raw) == sorted(brute_lines(docs, least))


def test_folding_finds_the_longest_shared_prefix():
    """A fold cut in two, and what is open of both folded again, equals one fold of all."""
    import pandas as pd

    rng = random.Random(13)
    for _ in range(200):
        n = rng.randrange(2, 30)
        rows = pd.DataFrame({"rank": range(n), "seq": rng.sample(range(100), n), "at": [0] * n, "lcp": [0, *(rng.choice((0, 1, 2, 2, 3, 5)) for _ in range(n - 1))], "best": [0] * n, "open": [True] * n})
        whole = lines._fold(rows).set_index("rank")["best"]
        seq, lcp = rows["seq"].tolist(), rows["lcp"].tolist()
        assert whole.tolist() == [max([min(lcp[min(i, j) + 1 : max(i, j) + 1]) for j in range(n) if seq[j] < seq[i]], default=0) for i in range(n)]
        cut_at = rng.randrange(1, n)
        parts = pd.concat([lines._fold(rows[:cut_at]), lines._fold(rows[cut_at:])])
        again = lines._fold(parts[parts["open"]])
        best = pd.concat([parts[~parts["open"]], again]).set_index("rank")["best"].sort_index()
        assert best.tolist() == whole.tolist()


def test_lines_with_a_million_blanks(spark):
    run = "\n".join(f"{x} and more words of it {x}" for x in range(12))
    wide = "a" + " " * 1_000_000 + "b"
    rows = {r.doc_id: r for r in lines.digests(docs_of(spark, [(1, run + "\n" + wide, "", ""), (2, "\t" + wide + " \r\n" + run.replace("\n", " \n\t"), "", ""), (3, " " * 1_000_000, "", "")])).collect()}
    assert rows[1].n_removed == 0 and rows[2].removed_lines == list(range(1, 13)) and rows[3].n_lines == 1


def test_lines_odd_inputs(odd, none):
    kept_as_they_are(lines.without_repeats(odd, 3), odd)
    rows = lines.digests(odd, 3).collect()
    assert len(rows) == odd.count() and lines.digests(none).count() == 0
    assert {(r.n_lines, r.n_removed) for r in rows if r.doc_id == 3} == {(0, 0)} and {r.n_removed for r in rows if r.doc_id == 1} == {1}


def test_words_are_hashed_alike_anywhere():
    a = segment.words(segment.codepoints(["x foo", "bar"])[0])[2]
    b = segment.words(segment.codepoints(["bar", "foo  x"])[0])[2]
    assert set(a.tolist()) == set(b.tolist()) and len(a) == 3
