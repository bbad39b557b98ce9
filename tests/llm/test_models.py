"""Language model, personal data, mixing, toxicity, encoding and fingerprints."""

import hashlib
import itertools
import math
import os
import random
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from agrolith.llm import bpe, hmm, merkle, mixing, pii, toxicity


# language model


def test_expected_counts_against_all_paths():
    rng = np.random.default_rng(1)
    p = hmm.Parameters.initial(3)
    p.move, p.start = rng.dirichlet([1, 1, 1], 3), rng.dirichlet([1, 1, 1])
    sequences = [np.array(s + [hmm.CLASSES], np.int32) for s in ([5, 9], [7], [5, 5, 9, 7], [])]
    totals = hmm.blank(3)
    likelihood = hmm.expected_counts(p, sequences, totals)
    start, move, emit = hmm.blank(3)
    total = 0.0
    for s in sequences:
        paths = []
        for path in itertools.product(range(3), repeat=len(s)):
            weight = p.start[path[0]] * p.emit[s[0], path[0]]
            for i in range(1, len(s)):
                weight *= p.move[path[i - 1], path[i]] * p.emit[s[i], path[i]]
            paths.append((path, weight))
        z = sum(w for _, w in paths)
        total += math.log10(z)
        for path, w in paths:
            start[path[0]] += w / z
            for i in range(len(s)):
                emit[s[i], path[i]] += w / z
                if i:
                    move[path[i - 1], path[i]] += w / z
    assert likelihood == pytest.approx(total)
    for got, expected in zip(totals, (start, move, emit), strict=True):
        assert np.allclose(got, expected)


def test_language_model(stored_docs, plain):
    got = hmm.language_model(stored_docs).collect()
    assert len(got) == len(plain)
    tokens = [text.encode().lower().split() + [b" "] for _, text in plain]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in plain]
    counts = Counter(t for own, out in zip(tokens, held, strict=True) if not out for t in own)
    n, v = sum(counts.values()), len(counts)
    base = lambda own: sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
    expected = sorted((-1 if i is None else i, out, len(own), sum(t in counts for t in own), round(base(own), 6)) for (i, _), own, out in zip(plain, tokens, held, strict=True))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == expected
    assert {r.train_tokens for r in got} == {n}
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_scores_against_all_paths(spark):
    """The whole score of a text: word counts within classes, and the sum over all paths of states."""
    rows = [(at, text) for at, text in enumerate(["ab cd ab", "cd ab", "ab xy", "", "cd cd ab xy"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = hmm.word_counts(docs)
    lex, p = hmm.lexical(counts), hmm.Parameters.initial(3)
    p.start = np.array([0.5, 0.3, 0.2])
    scored = {r.doc_id: r for r in hmm.score_documents(docs, p, lex, counts).collect()}
    own = {bytes(r.word): r.n for r in counts.collect()}
    cls = lambda w: hmm.CLASS_OF[w]
    totals, kinds = Counter(), Counter()
    for word, n in own.items():
        totals[cls(word)] += n
        kinds[cls(word)] += 1
    for doc_id, text in rows:
        words = [w.encode() for w in text.split()] + [hmm.END]
        alpha = p.start * p.emit[cls(words[0])]
        for word in words[1:]:
            alpha = (alpha @ p.move) * p.emit[cls(word)]
        lexical = sum(math.log10((own.get(w, 0) + 0.1) / (totals[cls(w)] + 0.1 * (kinds[cls(w)] + 1))) for w in words)
        assert scored[doc_id].words + scored[doc_id].model == pytest.approx(math.log10(alpha.sum()) + lexical)


def test_layouts_give_the_same_models(spark, stored_docs):
    """Another order and another number of partitions of the same rows change no result."""
    other = stored_docs.repartition(5, "text").sortWithinPartitions("n_chars")
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(60)], "doc_id bigint, quality int, toxic int")
    a, b = hmm.start_parameters(stored_docs, 20), hmm.start_parameters(other, 20)
    assert np.allclose(a.emit, b.emit) and np.allclose(a.move, b.move)
    f, g = pii.fit_sample(stored_docs, 20), pii.fit_sample(other, 20)
    assert np.allclose(f.emission, g.emission) and f.skip == pytest.approx(g.skip)
    m, n = toxicity.fit_labelled(stored_docs, labels), toxicity.fit_labelled(other, labels)
    assert (m.words, m.prefixes, m.bias, m.top) == (n.words, n.prefixes, n.bias, n.top)


def test_classes_sum_to_one():
    """P(word | class) of a class's known words and one unseen word sum to one."""
    counts = {b"aa": 3, b"ab": 1}
    lex = hmm.Lexical(4, 2, np.array([4.0]), np.array([2.0]), counts)
    total = sum(10 ** (math.log10(c + 0.1) - lex.by_class[0]) for c in [*counts.values(), 0])
    assert total == pytest.approx(1)


def test_language_model_of_nothing(empty):
    assert hmm.language_model(empty).count() == 0


# personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
PHONE, IP, CARD = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+")


def slow_luhn(digits):
    values = [int(d) for d in digits[::-1]]
    return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(values)) % 10 == 0


def slow_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and slow_luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15],
    }


@pytest.mark.parametrize("letters", ["a.@-1 ", "0123.456789 -+()", "@a.b+", "1.2 -", "4 1é@."])
def test_base_spans(letters):
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == slow_spans(text)


def test_base_spans_take_linear_time():
    pii.base_spans("1" * 300_000 + " " + "a" * 300_000 + "@" + "1.2." * 50_000)


def sample():
    rng = random.Random(9)
    out = []
    for _ in range(120):
        number = "".join(rng.choice("0123456789") for _ in range(10))
        out.append(f"call +1 ({number[:3]}) {number[3:6]}-{number[6:]} or write a.b{number[:2]}@mail.example.com from 10.0.{number[0]}.{number[1]} about order {number[:6]}, call +1 ({number[:3]}) {number[3:6]}-{number[6:]}")
    return out


def test_field_adds_copies_and_nothing_else():
    field = pii.fit(sample())
    text = "Call +1 (487) 555-7209 now. Later 487-555-7209 again; order 99887766, code 1234567."
    spans = pii.base_spans(text)
    assert [(k, text[a:b]) for k, a, b in field.added(text, spans)] == [("phone", "487-555-7209")]
    for clean in ("order 99887766 and order 99887766", "", "no numbers at all", "1 2 3 4 5 6 7"):
        assert field.added(clean, pii.base_spans(clean)) == []


@pytest.mark.parametrize("form", ["487 555 7209", "(487) 555 7209", "(487) 555-7209", "555 7209", "1 487 555 7209"])
def test_field_ties_spaced_forms(form):
    field = pii.fit(sample())
    text = f"Call +1 (487) 555-7209 now. Later {form} again; order 99 88 77 66 55, code 123 4567."
    assert [(k, text[a:b]) for k, a, b in field.added(text, pii.base_spans(text))] == [("phone", form)]


def test_marginals_against_enumeration():
    """On a field without loops (one clique, no chain) messages are exact; with a chain they come close."""
    rng = np.random.default_rng(5)
    k = len(pii.LABELS)
    words = ["4875557209", "order", "487-555-7209", "x1", "4875557209"]
    field = pii.Field(rng.normal(0, 0.4, (k, pii.WIDTH)), np.zeros((k, k)), 1.7)
    clamped = np.array([4, 0, 0, 0, 0])

    def exact(field):
        unary = field.unary(words)
        groups, h = pii.groups_of(words), pii.hub_strength(field.skip)
        out = np.zeros((len(words), k))
        for labels in itertools.product(range(k), repeat=len(words)):
            if labels[0] != 4:
                continue
            weight = np.exp(sum(unary[i, y] for i, y in enumerate(labels)) + sum(field.chain[a, b] for a, b in zip(labels, labels[1:], strict=False)))
            for group in groups:
                weight *= sum(np.exp(h * sum(labels[i] == hub for i in group)) for hub in range(k))
            for i, y in enumerate(labels):
                out[i, y] += weight
        return out / out.sum(axis=1, keepdims=True)

    groups = [set(g) for g in pii.groups_of(words)]
    assert all(g <= {0, 2, 4} for g in groups)
    field.chain[:] = 0
    single = pii.Field(field.emission, field.chain, 1.7)
    pii_groups = pii.groups_of
    pii.groups_of = lambda w: pii_groups(w)[:1]
    try:
        assert np.allclose(single.marginals(words, clamped), exact(single), atol=1e-4)
        chained = pii.Field(field.emission, rng.normal(0, 0.3, (k, k)), 1.7)
        assert np.abs(chained.marginals(words, clamped) - exact(chained)).max() < 0.08
    finally:
        pii.groups_of = pii_groups


def test_hub_agrees_as_a_pair():
    k, skip = len(pii.LABELS), 1.3
    h = pii.hub_strength(skip)
    pair = lambda same: sum(np.exp(h * ((hub == 0) + (hub == (0 if same else 1)))) for hub in range(k))
    assert np.log(pair(True) / pair(False)) == pytest.approx(skip)


def test_find(stored_docs, spark):
    rows = [(1, sample()[0]), (2, None), (3, ""), (None, "é 4539578763621486")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.find(docs, pii.fit_sample(docs)).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 0, 2)
    assert got[2].base_sha256 == got[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[None].spans == "card:2:18" and got[None].n_spans == 1 and got[2].n_spans == 0
    assert pii.redact(rows[0][1], got[1].spans).startswith("call [phone] or write [email] from [ip]")
    assert pii.find(stored_docs, pii.fit([])).count() == stored_docs.count()


# mixing


def test_mixing_meets_targets(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for at in range(400):
        good = at % 4 != 0
        words = [rng.choice(["Alpha", "beta.", "Gamma"]) if good else rng.choice(["%%%x", "!!yy", "##"]) for _ in range(rng.randint(5, 60))]
        rows.append((at, " ".join(words)))
        if at % 3:
            labels.append((at, int(good), 0))
    for at in range(400, 440):
        rows.append((at, "Alpha nasty beta. nasty " * 3))
        labels.append((at, 1, 1))
    rows += [(None, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = spark.createDataFrame([*labels, (None, 1, 0), (5, None, None)], "doc_id bigint, quality int, toxic int")
    fitted, reached = mixing.rates(docs, table)
    got = fitted.collect()
    assert len(got) == len(rows) and all(r.rate >= 0 for r in got)
    p, n, r = np.array([x.p for x in got]), np.array([x.tokens for x in got]), np.array([x.rate for x in got])
    total = sum(len((t or "").split()) for _, t in rows)
    assert n.sum() == total and np.allclose(p.sum(axis=1), 1)
    for at, name in enumerate(reached):
        assert (r * n) @ p[:, at] == pytest.approx(total * mixing.TARGETS[name], rel=1e-4)
        assert reached[name][1] == pytest.approx((r * n) @ p[:, at], rel=1e-6)
    by_domain = p.argmax(axis=1)
    assert np.mean([r[by_domain == 0].mean() > r[by_domain == 2].mean()]) == 1


def test_thinning_meets_reachable_shares(spark):
    """Rates in [0, 1] with the shares wanted, against the conditions that only the nearest such rates fulfil."""
    rng = np.random.default_rng(3)
    p, n = rng.dirichlet([6, 0.4, 0.5], 600), rng.integers(1, 500, 600).astype(float)
    table = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(n, p, strict=True)], "tokens bigint, p array<double>")
    rate, shares = mixing.box_rates(table, ["good", "rough", "toxic"], mixing.TARGETS)
    got = table.withColumn("rate", rate).collect()
    p, n, r = np.array([x.p for x in got]), np.array([x.tokens for x in got]), np.array([x.rate for x in got])
    asked = np.minimum(n.sum() * np.array(list(mixing.TARGETS.values())), n @ p)
    kept = (r * n) @ p
    assert r.min() >= 0 and r.max() <= 1 and kept.sum() > 0.3 * n.sum()
    assert kept / kept.sum() == pytest.approx(asked / asked.sum(), rel=1e-4)
    assert [own[2] for own in shares.values()] == pytest.approx(kept / kept.sum(), rel=1e-6)
    inner = (r > 1e-6) & (r < 1 - 1e-6)
    v = np.linalg.lstsq(p[inner], r[inner] - 1, rcond=None)[0]
    assert abs(v @ asked) < 1e-5 * asked.sum() and np.allclose(r, np.clip(1 + p @ v, 0, 1), atol=1e-6)


def test_mixing_without_labels(stored_docs, spark, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    fitted, _ = mixing.rates(stored_docs, none)
    assert {r.rate for r in fitted.collect()} == {1.0}
    assert mixing.thin(stored_docs, none).count() == stored_docs.count()
    assert mixing.thin(empty, none).count() == 0


def test_posteriors_and_rates_by_brute_force(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for at in range(150):
        style = at % 3
        words = [rng.choice((["alpha", "beta."], ["%%%x", "!!yy"], ["nasty", "beta."])[style]) for _ in range(rng.randint(3, 40))]
        rows.append((at, " ".join(words)))
        if at % 2:
            labels.append((at, int(style != 1), int(style == 2)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    fitted, _ = mixing.rates(docs, table)
    got = sorted(fitted.collect(), key=lambda r: r.doc_id)
    words = mixing.telling_words(docs, mixing.labelled(table))
    columns = mixing.features(mixing.F.col("text"), words)
    found = {r.doc_id: r for r in docs.select("doc_id", *(c.alias(n) for n, c in columns.items())).collect()}
    names = [n for n in columns if n != "tokens"]
    domain = {i: 2 if toxic else 0 if quality else 1 for i, quality, toxic in labels}
    total = Counter(domain.values())
    for r in got:
        logits = []
        for k in range(3):
            logit = math.log(total[k] / len(domain))
            for name in names:
                same = sum(domain[i] == k and found[i][name] == found[r.doc_id][name] for i in domain)
                logit += math.log((same + 0.5) / (total[k] + 0.5 * mixing.BINS))
            logits.append(math.exp(logit))
        assert r.p == pytest.approx([x / sum(logits) for x in logits], abs=1e-9)
    p, r, n = np.array([x.p for x in got]), np.array([x.rate for x in got]), np.array([x.tokens for x in got])
    targets = n.sum() * np.array(list(mixing.TARGETS.values()))
    assert (r * n) @ p == pytest.approx(targets, rel=1e-4) and r.min() >= 0
    # a plain projected gradient with many small steps meets the same targets, too
    slow = np.ones(len(n))
    a = p * n[:, None]
    step = 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(200_000):
        slow = np.maximum(0, slow - step * (a @ (slow @ a - targets)))
    assert slow @ a == pytest.approx(targets, rel=1e-2)


# toxicity


def toxic_rows(n=600):
    rng = random.Random(7)
    filler = [f"w{i}" + "abcdefgh"[i % 8] * 2 for i in range(80)]
    filler = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(80)]
    rows = []
    for at in range(n):
        words = [rng.choice(filler) for _ in range(rng.randint(5, 60))]
        toxic = at % 8 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["Zork", "blarg!", "flumpish", "flumper"]))
        rows.append((at, " ".join(words) + ".", int(toxic)))
    return rows


def test_toxicity_held_out(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit_labelled(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    for i, _, y in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and got[i].predicted == int(got[i].score >= 0.3)
    held = [(y, got[i].predicted) for i, _, y in rows if got[i].held_out]
    assert np.mean([y == p for y, p in held]) > 0.97
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].predicted}


def test_toxicity_is_not_fitted_on_the_driver(stored_docs, spark, monkeypatch):
    labels = spark.createDataFrame([(n, n % 2) for n in range(40)], "doc_id long, toxic int")
    before = toxicity.fit_labelled(stored_docs, labels)
    inner, home = toxicity.fit, os.getpid()

    def elsewhere(texts, toxic):
        assert os.getpid() != home
        return inner(texts, toxic)

    monkeypatch.setattr(toxicity, "fit", elsewhere)
    model = toxicity.fit_labelled(stored_docs, labels)
    assert (model.words, model.prefixes, model.bias) == (before.words, before.prefixes, before.bias)


def test_toxicity_edges(stored_docs, spark, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit_labelled(stored_docs, none)
    assert toxicity.keep_clean(stored_docs, model).count() == stored_docs.count()
    assert toxicity.score_documents(empty, model).count() == 0
    assert all(0 <= r.score <= 1 for r in toxicity.score_documents(stored_docs, model).collect())


def test_grammar():
    m = toxicity.Model({"idiot": 5.0}, {"flump": 4.0}, {}, 0.0, 0.0)
    read = lambda clause: dict(m.read(clause)[0])
    assert read("an idiot came") == {toxicity.INSULT: 1}
    assert read("you big idiot") == {toxicity.AIMED: 1}
    assert read("not an idiot") == {toxicity.MUTED: 1}
    assert read("she said you are an idiot") == {toxicity.QUOTED: 1}
    assert read("he is flumpish and you kill") == {toxicity.INSULT: 1, toxicity.AIMED_THREAT: 1}
    ranked = lambda text: [dict(own[0]) for own in m.ranked(text)]
    quoted, aimed, muted = [{toxicity.QUOTED: 1}], [{toxicity.AIMED: 1}], [{toxicity.MUTED: 1}]
    assert ranked("She said: you idiot") == ranked("she said, you idiot") == ranked("he wrote to his friend: you idiot") == quoted
    assert ranked("my list: you idiot") == ranked("he said it. so: you idiot") == aimed
    assert ranked("You aren\u2019t an idiot") == ranked("you aren't an idiot") == muted
    assert ranked("it\u2019s not an idiot") == muted and ranked("said: all is well") == []
    assert list(toxicity.clauses("good day. you idiot! bye", m.hits)) == [" you idiot"]
    assert list(toxicity.clauses("idiotic", m.hits)) == []


def test_composed_machine_is_its_parts_in_turn():
    rng = np.random.default_rng(1)
    weights = {kind: float(rng.normal()) for kind in toxicity.MATCHED}
    parts = [toxicity.within(toxicity.REPORT, 1, {toxicity.INSULT: toxicity.QUOTED, toxicity.THREAT: toxicity.QUOTED}, keeps=True), toxicity.within(toxicity.NEGATION, 3, {toxicity.INSULT: toxicity.MUTED, toxicity.THREAT: toxicity.MUTED}), toxicity.within(toxicity.TARGET, 3, {toxicity.INSULT: toxicity.AIMED, toxicity.THREAT: toxicity.AIMED_THREAT}), toxicity.scorer(weights)]
    whole = toxicity.grammar(weights)

    def run(machine, symbols):
        state, out, total = 0, [], 0.0
        for s in symbols:
            out.append(int(machine.out[state, s]))
            total += machine.weight[state, s]
            state = machine.next[state, s]
        return out, total

    for _ in range(300):
        symbols = rng.integers(0, toxicity.NEGATION + 2, rng.integers(0, 25)).tolist()
        expected, total = symbols, 0.0
        for part in parts:
            expected, own = run(part, expected)
            total += own
        got, weight = run(whole, symbols)
        assert got == expected and weight == pytest.approx(total)


def test_score_is_the_fitted_function(spark):
    rows = toxic_rows(200)
    model = toxicity.fit([t for _, t, _ in rows], [y for *_, y in rows])
    many = ". ".join(["you zork"] * 60 + ["not a zork"] * 70)
    for text in [t for _, t, _ in rows] + [many, "", None]:
        x = model.describe(text)
        logit = model.bias + x[:-1] @ weights_of(model) + model.top * x[-1]
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, logit)))))


def weights_of(model):
    """The arc weight with which the machine emits each matched class."""
    out = []
    for kind in toxicity.MATCHED:
        places = np.argwhere(model.machine.out == kind)
        out.append(model.machine.weight[tuple(places[0])])
    return np.array(out)


# encoding


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(bpe.default_path())


def by_library(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False).encode()


def through(text, v, chunk=bpe.CHUNK):
    decoder, ids, decoded = bpe.Decoder(v), b"", b""
    for some in bpe.encoded_stream(text.encode(), v, chunk):
        ids, decoded = ids + some.tobytes(), decoded + decoder.feed_block(some)
    return ids, decoded


def test_encoding(library, texts):
    v, rng = bpe.vocabulary(bpe.default_path()), random.Random(1)
    cases = [t or "" for t in texts] + ["x" * 9000, "ab" * 5000, "I'm don't 'S !'s ''s", "<|endoftext|>a<|startoftext|> B<|", "ΣΑΣ İ ﬀ é \x1c \x85 ᲊ 𐗃", "1234 ½ ² 一二"]
    for letters in ("abt", "aeinth' ", "é ß#", "ABC<|endoftext|> x"):
        cases += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(100)]
    for text in cases:
        assert through(text, v) == by_library(library, text)
        assert through(text, v, 7) == by_library(library, text)


@pytest.mark.parametrize("letters", ["abcdeint", "0123456789", "01a2!", "1\u0301²3٤٥", "aİé'sΣ", "한국ᄀ\u1161\u11a8a", "ab1'!.re", "ab<|endoftext|>", "一丁丂か\u3099", "é\u0301eﬁ"])
def test_long_words_are_cut(library, letters, monkeypatch):
    """Words without an end go through in stretches, whatever letters stand at their borders."""
    monkeypatch.setattr(bpe, "BLOCK", 40)
    v, rng = bpe.vocabulary(bpe.default_path()), random.Random(8)
    for _ in range(60):
        text = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 400))) for _ in range(3))
        encoder, most = bpe.Encoder(v), 0
        for at in range(0, len(data := text.encode()), 11):
            encoder.feed(data[at : at + 11])
            most = max(most, len(encoder.held))
        assert through(text, v, 11) == by_library(library, text)
        assert most < 120 or letters not in ("abcdeint", "0123456789")


def test_digits_are_cut_in_linear_time(library):
    """A word of digits is held in one stretch at most, and eight times as many take about eight times as long."""
    v, took = bpe.vocabulary(bpe.default_path()), []
    for size in (1 << 20, 8 << 20):
        data = (b"0123456789" * (size // 10 + 1))[:size]
        encoder, held, began = bpe.Encoder(v), 0, time.perf_counter()
        out = []
        for at in range(0, size, bpe.CHUNK):
            out.append(encoder.feed(data[at : at + bpe.CHUNK]))
            held = max(held, len(encoder.held))
        out.append(encoder.close())
        took.append(time.perf_counter() - began)
        assert held <= 2 * bpe.CHUNK
        if size == 1 << 20:
            assert b"".join(out) == by_library(library, data.decode())[0]
    assert took[1] < 12 * took[0]


def test_words_without_a_place_to_cut_are_searched_once(monkeypatch):
    v, looked = bpe.vocabulary(bpe.default_path()), []
    inner = bpe.cut_of
    monkeypatch.setattr(bpe, "cut_of", lambda text, special: looked.append(len(text)) or inner(text, special))
    encoder = bpe.Encoder(v)
    for _ in range(20):
        encoder.feed(b"!-" * bpe.CHUNK)
    assert len(looked) > 10 and max(looked[2:]) < 3 * bpe.CHUNK


def test_long_merges():
    v, rng = bpe.vocabulary(bpe.default_path()), random.Random(3)
    for _ in range(200):
        symbols = [v.inner[rng.choice(b"abeinrst")] for _ in range(rng.randint(1, 64))]
        assert v.merge_long(list(symbols)) == v.merge(list(symbols))


def test_streaming_equals_whole():
    v, rng = bpe.vocabulary(bpe.default_path()), random.Random(4)
    for _ in range(20):
        data = "".join(rng.choice("abcdeinthrs") for _ in range(rng.randint(1, 6000))).encode()
        t, got = bpe.Transducer(v, 64), []
        for at in range(0, len(data), 7):
            got += t.feed(data[at : at + 7])
            assert len(t.held) <= 64 + v.lookahead + 64
        assert [*got, *t.close()] == v.merge([*map(v.inner.__getitem__, data[:-1]), v.final[data[-1]]])


def test_new_words_are_merged_together(library, monkeypatch):
    """Words that documents bring are learnt before these are encoded, so hardly one is merged by itself."""
    v, rng, merges = bpe.vocabulary(bpe.default_path()), random.Random(5), []
    v.forget()
    words = ["".join(rng.choice("abcdeinthrsé'.,1") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    odd = ["ΣΑΣ", "İ", "e\u0301a", "\u0301a", "a\xa0b", "\x85", "\x1c", "don't", "''s", "a<|endoftext|>b", "<|", "日本", "x" * 64, "x" * 65, "½²", "´s"]
    texts = [" ".join(rng.choice(words + odd * 5) for _ in range(rng.randint(0, 400))) for _ in range(40)] + ["", " ", " ".join(odd), "é" * bpe.CHUNK]
    monkeypatch.setattr(bpe, "NEW_WORDS", 1000)
    inner = v.merge
    monkeypatch.setattr(v, "merge", lambda symbols: merges.append(1) or inner(symbols))
    blocks = [*v.blocks(text.encode() for text in texts)]
    assert [text for block in blocks for text in block] == [text.encode() for text in texts] and len(blocks) > 2
    for text in texts:
        assert through(text, v) == by_library(library, text)
    assert len(merges) < 300
    v.forget()
    assert [*v.blocks(iter([]))] == [[]]


def test_decoding_to_text():
    v = bpe.vocabulary(bpe.default_path())
    d = bpe.Decoder(v, "text")
    ids = [n for w in "über 日本 ok".split() for n in np.frombuffer(v.word(w), "<u4").tolist()]
    assert "".join(map(d.feed, ids)) + d.close() == "über 日本 ok "


def test_encoded_documents(library, stored_docs, plain):
    got = bpe.encode_documents(stored_docs, digests=True).collect()
    expected = Counter()
    for doc_id, text in plain:
        ids, decoded = by_library(library, text)
        expected[(doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())] += 1
    assert Counter(map(tuple, got)) == expected
    full = bpe.encode_documents(stored_docs.limit(5)).first()
    assert isinstance(full.ids, list) and isinstance(full.decoded, str)


# fingerprints


def plain_tree(text):
    """(root, [(section digest, its blocks)], paragraph digests) by hashlib."""
    sha = lambda data: hashlib.sha256(data.encode()).hexdigest()
    lines = text.split("\n")
    blocks = [[line[at : at + merkle.BLOCK] for at in range(0, len(line), merkle.BLOCK)] for line in lines]
    paragraphs = [sha("p" + "".join(sha("b" + b) for b in own)) for own in blocks]
    sections = [(sha("s" + "".join(paragraphs[at : at + merkle.SECTION])), [b for own in blocks[at : at + merkle.SECTION] for b in own]) for at in range(0, len(lines), merkle.SECTION)]
    return sha("r" + "".join(s for s, _ in sections)), sections, paragraphs


def plain_likeness(a, b):
    x, y = plain_tree(a), plain_tree(b)
    if x[0] == y[0]:
        return 1.0
    both = {s for s, _ in x[1]} & {s for s, _ in y[1]}
    closed = [sum(len(own) for s, own in side[1] if s in both) for side in (x, y)]
    opened = [{block for s, own in side[1] if s not in both for block in own} for side in (x, y)]
    total = sum(closed) + sum(map(len, opened))
    return (sum(closed) + 2 * len(opened[0] & opened[1])) / total if total else 0.0


def test_merkle(stored_docs, plain):
    tree, edited = merkle.F.col("tree"), merkle.F.col("edited_tree")
    got = merkle.with_edits(stored_docs).select("doc_id", "n_chars", "edited", "tree", "edited_tree", merkle.likeness(merkle.compact(tree), merkle.compact(edited)).alias("near"), merkle.likeness(merkle.compact(tree), merkle.F.col("next_tree")).alias("next"), merkle.differing(tree, edited).alias("differ")).collect()
    order = sorted(range(len(plain)), key=lambda at: (plain[at][0] is None, -(plain[at][0] or 0), at))
    expected = Counter()
    for place, at in enumerate(order):
        doc_id, text = plain[at]
        following, half = plain[order[(place + 1) % len(order)]][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected[(doc_id, len(text), edited, plain_tree(text)[0], plain_tree(edited)[0], round(plain_likeness(text, edited), 9), round(plain_likeness(text, following), 9))] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited, r.tree.root, r.edited_tree.root, round(r.near, 9), round(r.next, 9)) for r in got) == expected
    for r in got:
        assert (r.differ == []) == (r.tree.root == r.edited_tree.root)


def test_merkle_likeness_of_moved_sections(spark):
    rng = random.Random(4)
    line = lambda: " ".join(rng.choice("abcdefgh") * 7 for _ in range(rng.randint(1, 30)))
    cases = []
    for _ in range(40):
        a = [line() for _ in range(rng.randint(1, 60))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            b[rng.randrange(len(b))] = line()
        if rng.random() < 0.3:
            b = b[8:] + [line()] if len(b) > 8 else b
        cases.append(("\n".join(a), "\n".join(b)))
    df = spark.createDataFrame(cases, "a string, b string").coalesce(1)
    near = merkle.likeness(*(merkle.compact(merkle.tree(merkle.F.col(c))) for c in "ab"))
    for (a, b), row in zip(cases, df.select("a", "b", near.alias("n")).collect(), strict=True):
        assert (row.a, row.b) == (a, b) and row.n == pytest.approx(plain_likeness(a, b))


def test_merkle_locates_an_edit(spark):
    lines = [f"line {i}" for i in range(40)]
    edited = [*lines]
    edited[21] = "other"
    df = spark.createDataFrame([("\n".join(lines), "\n".join(edited))], "a string, b string").select(merkle.tree(merkle.F.col("a")).alias("a"), merkle.tree(merkle.F.col("b")).alias("b"))
    row = df.select(merkle.differing(merkle.F.col("a"), merkle.F.col("b")).alias("d"), merkle.likeness(merkle.compact(merkle.F.col("a")), merkle.compact(merkle.F.col("b"))).alias("n")).first()
    assert row.d == [21] and 0.9 < row.n < 1


def test_merkle_of_nothing(empty):
    assert merkle.with_edits(empty).count() == 0


def test_no_rows(empty, spark):
    assert pii.find(empty, pii.fit([])).count() == 0 and pii.fit_sample(empty).skip == 0
    assert bpe.encode_documents(empty).count() == 0 and bpe.encoded_digests(empty).count() == 0


def test_classes_of_many_words_are_found_at_once(monkeypatch):
    """Numbered words have the classes that each has alone, also once numbers are given anew."""
    words = [b"a", b"of", b"word", b"longer,", b"another-one", "é".encode(), "Übergröße".encode(), "日本".encode()]
    alone, counted = hmm.word_class, []
    monkeypatch.setattr(hmm, "word_class", lambda word: counted.append(word) or alone(word))
    monkeypatch.setattr(hmm, "CACHE", 4)
    hmm.NUMBERS.clear()
    texts = [words, [], words[::-1] * 2, [b"new", b"words", b"of", b"a"]]
    for _ in range(3):
        for text, found in zip(texts, hmm.class_sequences(texts), strict=True):
            assert found.tolist() == [*map(alone, text), hmm.CLASSES]
    assert hmm.classes_of([b"a", hmm.END]).tolist() == [alone(b"a"), hmm.CLASSES]
    assert not [word for word in counted if word.isascii()]
    hmm.NUMBERS.clear()
