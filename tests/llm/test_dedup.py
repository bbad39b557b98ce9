"""Exact, near, substring and line deduplication against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from agrolith.llm import components, exact_dedup, fuzzy_lines, jaccard_join, recompression
from agrolith.llm.common import stored


def az(text):
    return text.encode().lower().decode()


def test_exact(stored_docs, plain):
    groups = defaultdict(list)
    for doc_id, text in plain:
        groups[az(text)].append(doc_id)
    got = exact_dedup.deduplicate(stored_docs).collect()
    assert len(got) == len(plain)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for row in got:
        ids = by_hash[row.text_sha256]
        best = max((i for i in ids if i is not None), default=None)
        assert (row.keep_id, row.group_size) == (best, len(ids))
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(dict.fromkeys(by_hash, 1))


def test_exact_keeps_columns_and_frames_that_are_no_scan(stored_docs, docs):
    kept = exact_dedup.keep_first(stored_docs)
    assert kept.columns == stored_docs.columns
    n = len({az(r.text or "") for r in stored_docs.collect()})
    assert kept.count() == n and exact_dedup.keep_first(docs).count() == n


def test_exact_state_goes_on(spark, tmp_path):
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    for ids in ([1, 5], [9]):
        exact_dedup.append_log(spark.createDataFrame([(i, "same") for i in ids], "doc_id bigint, text string"), log)
        exact_dedup.advance(spark, log, state)
    row = exact_dedup.state(spark, state).collect()
    assert [(r._keep._doc, r._size) for r in row] == [(9, 3)]


def test_digest_collision_stops(spark, stored_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda column, bits: exact_dedup.F.lit("00" * 32))
    with pytest.raises(Exception, match="share a digest"):
        exact_dedup.deduplicate(stored_docs).collect()


def shingle_set(text, n=3):
    words = text.encode().lower().split()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def classes(plain, percent, n):
    sets = [shingle_set(text, n) for _, text in plain]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(sets)):
        members[find(i)].append(plain[i][0])
    return Counter((plain[i][0], len(sets[i]), min((m for m in members[find(i)] if m is not None), default=None)) for i in range(len(sets)))


@pytest.mark.parametrize(("percent", "n"), [(90, 3), (80, 5), (50, 2)])
def test_jaccard(stored_docs, plain, percent, n):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.classes_of(stored_docs, n, percent).collect())
    assert got == classes(plain, percent, n)


def test_jaccard_long_lists_in_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_PART", 4)
    rare = " ".join(f"w{i}" for i in range(60))
    rows = [(at, rare.replace(f"w{at % 50} ", f"x{at} ")) for at in range(80)] + [(1000 + at, " ".join(f"y{at}z{i}" for i in range(40))) for at in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.classes_of(docs).collect())
    assert got == classes(rows, 90, 3)


def test_jaccard_small_sizes():
    assert jaccard_join.small_sizes(90) == range(9, 18) and jaccard_join.small_sizes(80) == range(4, 8)
    for percent in (50, 80, 90, 95):
        sizes = jaccard_join.small_sizes(percent)
        for n in sizes:  # n and n + 1 link, n and n + 2 and substitutions don't
            assert 100 * n >= percent * (n + 1) and 100 * n < percent * (n + 2) and 100 * (n - 1) < percent * (n + 1)


def test_keep_one(stored_docs, plain):
    kept = jaccard_join.keep_one(stored_docs, 5, 80)
    assert kept.columns == stored_docs.columns
    sets = [shingle_set(text, 5) for _, text in plain]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    best = {}
    for at, (doc_id, _) in enumerate(plain):
        key = (doc_id is None, doc_id or 0)
        best[find(at)] = min(best.get(find(at), (True, 1 << 60)), key)
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == Counter(best.values())


def repeats(plain, window):
    words = [text.encode().split() for _, text in plain]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(plain, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((doc_id, len(w), sum(gone), " ".join(x.decode() for x, g in zip(w, gone, strict=True) if not g)))
    return Counter(out)


@pytest.mark.parametrize("block", [200, 1_500_000])
def test_substrings(stored_docs, plain, block, monkeypatch):
    monkeypatch.setattr(recompression, "BLOCK_WORDS", block)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in recompression.remove_repeats(stored_docs).collect())
    assert got == repeats(plain, 35)


def test_equal_windows_pick_equal_symbols():
    rng = np.random.default_rng(5)
    vocabulary = [b"w%d" % i for i in range(12)]
    inner = rng.choice(vocabulary, 80).tolist()
    picks = []
    for _ in range(20):
        left, right = rng.choice(vocabulary, rng.integers(1, 30)).tolist(), rng.choice(vocabulary, rng.integers(1, 30)).tolist()
        block = recompression.Block([b" ".join(left + inner + right)])
        picks.append(block.picked(block.grams)[len(left) : len(left) + len(inner) - 34].tolist())
    assert all(p == picks[0] for p in picks)


def lines_of(plain, radius=64):
    first = {}
    order = sorted(range(len(plain)), key=lambda at: (plain[at][0] is None, plain[at][0] or 0, at))
    for at in order:
        for number, line in enumerate(plain[at][1].encode().split(b"\n")):
            if (line := fuzzy_lines.normalised(line)) and line not in first:
                first[line] = (len(first), at, number)
    lines = list(first)
    sims = fuzzy_lines.simhashes([list(dict.fromkeys(line.split())) for line in lines])
    parent = list(range(len(lines)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(lines)):
        for j in np.flatnonzero(np.bitwise_count(sims[:i] ^ sims[i]) <= radius):
            if fuzzy_lines.similar(lines[i], lines[j]):
                a, b = find(i), find(int(j))
                parent[max(a, b)] = min(a, b)
    return {(at, number) for line, (place, at, number) in first.items() if find(place) == place}


def test_fuzzy_lines(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"word{i}" for i in range(200)]
    base = [" ".join(rng.choice(vocabulary, 40)) for _ in range(20)]
    rows = []
    for at in range(60):
        lines = [base[at % 20].replace(" ", "  ").title(), base[(at * 7) % 20].replace("word", "Word", 1)]
        lines.append(base[at % 20] + f" {rng.choice(vocabulary)}")
        rows.append((at, "\n".join(lines) + ("\n" if at % 2 else "")))
    rows += [(100, None), (101, ""), (None, base[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    plain = [(i, t or "") for i, t in rows]
    stays = lines_of(plain)
    expected = Counter()
    for at, (doc_id, text) in enumerate(plain):
        lines = text.split("\n") if text else []
        left = [line for number, line in enumerate(lines) if (at, number) in stays or not line.split()]
        expected[(doc_id, len(lines), len(lines) - len(left), "\n".join(left))] += 1
    got = Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in fuzzy_lines.remove_fuzzy_lines(docs).collect())
    assert got == expected
    assert sum(k[2] * n for k, n in got.items()) > 60


def test_fuzzy_lines_of_few_words(spark):
    """An edited word moves more SimHash bits than NEAR in short lines; all pairs are linked nevertheless."""
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 8))) for _ in range(900)]
    base = [list(rng.choice(words, n)) for n in [9] * 30 + [27] * 30 + [60] * 30]
    lines = [" ".join(own) for own in base]
    for own in base:
        copy = list(own)
        copy[4] = str(rng.choice(words))
        lines.append(" ".join(copy))
    lines += ["are.", "anre.", "short one", "short ane"]
    plain = list(enumerate(lines))
    every = sum(len(t.split()) > 0 for _, t in plain) - len(lines_of(plain, 64))
    got = fuzzy_lines.remove_fuzzy_lines(spark.createDataFrame(plain, "doc_id bigint, text string"))
    assert sum(r.n_removed for r in got.collect()) >= 0.95 * every
    assert len(lines_of(plain, fuzzy_lines.NEAR)) > len(lines_of(plain, 64)) + 0.5 * every


def test_crowded_keys(spark, monkeypatch):
    monkeypatch.setattr(fuzzy_lines, "LOCAL", 3)
    monkeypatch.setattr(fuzzy_lines, "AT_ONCE", 5)
    test_fuzzy_lines(spark)


def test_names_of_words(monkeypatch):
    """Equal words have equal names, different ones different names, wherever they stand; a text's words are named together."""
    rng = np.random.default_rng(16)
    words = [bytes(rng.choice(list(b"ab\x00\x1f\xc3\xa9\xff"), n).tolist()) for n in [*range(1, 40)] * 6 + [510, 511, 512, 513, 514, 600]]
    monkeypatch.setattr(recompression.NameCache, "__missing__", lambda cache, word: pytest.fail("words are named one by one"))
    words += [b"a" * n for n in range(1, 30)] + [b"a" + b"\x00" * n for n in range(1, 30)]
    names = {}
    for _ in range(5):
        some = rng.permutation(len(words)).tolist()
        text = b"".join(words[at].upper() + bytes(rng.choice(list(b" \t\n\r\x0b\x0c"), rng.integers(1, 4)).tolist()) for at in some)
        for lead in (b"", b" \n"):
            found = jaccard_join.word_names(lead + text).tolist()
            assert len(found) == len(some)
            for at, name in zip(some, found, strict=True):
                assert names.setdefault(words[at].lower(), name) == name
    assert len(set(names.values())) == len(names) == len(set(words))
    for empty in (None, b"", b" \n\t"):
        assert len(jaccard_join.word_names(empty)) == 0
    counts = rng.integers(0, 50, jaccard_join.COUNTERS)
    own = jaccard_join.word_names(b" ".join(words[at] for at in rng.integers(0, 40, 400)))
    whole, expected, least = jaccard_join.shingles(own, 3, counts)
    assert whole.tolist() == sorted(set(jaccard_join.shingles(own, 3).tolist())) and len(whole) == len(expected) == len(least)


def test_long_lines_are_compared_together(monkeypatch):
    """Pairs of any number of words go step by step, whether equal letters stand at their beginning, end or middle."""
    rng = np.random.default_rng(15)
    text = lambda n: bytes(rng.choice(list(b"abcdefgh "), n).tolist())
    pairs, alone = [], fuzzy_lines.distance
    for n in [330, 500, 700] * 12:
        whole, share = text(n), int(n * rng.choice([0.5, 0.79, 0.85, 0.97]))
        pairs += [(whole, whole[:share] + text(n - share)), (whole, text(n - share) + whole[n - share :]), (whole, whole[: share // 2] + text(n - share) + whole[share // 2 : share])]
    most = np.array([max(len(a), len(b)) // 5 for a, b in pairs])
    exact = np.array([alone(a, b) for a, b in pairs])
    counted = []
    monkeypatch.setattr(fuzzy_lines, "distance", lambda *args: counted.append(args) or alone(*args))
    found = fuzzy_lines.distances(pairs, most)
    assert ((found <= most) == (exact <= most)).all() and (found[exact <= most] == exact[exact <= most]).all()
    assert 20 < (exact <= most).sum() < len(pairs) - 20 and len(counted) < len(pairs) / 2


def test_words_of_columns_go_together(monkeypatch):
    """All words of a column take one step, and pairs leave once what is left of both lines shows that they exceed their bound;
    distances are those that each pair has alone."""
    rng, pairs = np.random.default_rng(11), []
    for at in range(300):
        a = rng.integers(0, 20, int(rng.integers(900, 1000)), np.uint8)
        b = rng.integers(0, 20, int(rng.integers(900, 1000)), np.uint8) if at % 3 else np.delete(a, rng.integers(0, len(a), 5 * (at % 50)))
        pairs.append((a.tobytes(), b.tobytes()))
    most = np.array([max(map(len, pair)) * 20 // 100 for pair in pairs])
    exact = np.array([fuzzy_lines.distance(a, b) for a, b in pairs])

    class Counting:
        taken = 0

        def __getattr__(self, name):
            Counting.taken += name == "invert"
            return getattr(np, name)

    monkeypatch.setattr(fuzzy_lines, "np", Counting())
    found = fuzzy_lines.distances([pair for pair, own in zip(pairs, exact > most, strict=True) if own], most[exact > most])
    assert (found > most[exact > most]).all() and Counting.taken < 1200
    found = fuzzy_lines.distances(pairs, most)
    assert (found[exact <= most] == exact[exact <= most]).all() and (found[exact > most] > most[exact > most]).all()
    assert 50 < (exact <= most).sum() < 150


def test_pairs_of_nearly_as_many_words_go_together(monkeypatch):
    """Pairs of 20 widths go in a few groups, with the distances that each has alone."""
    rng = np.random.default_rng(16)
    text = lambda n: bytes(rng.choice(list(b"abcdefgh "), n).tolist())
    pairs = []
    for n in [64 * words - 5 for words in range(6, 26)] * 6:
        whole = text(n)
        other = bytearray(whole if rng.random() < 0.5 else text(n))
        for at in [0, n - 1, *rng.choice(n, n // 10)]:
            other[at] = ord("z")
        pairs.append((whole, bytes(other)))
    most = np.array([max(len(a), len(b)) // 5 for a, b in pairs])
    exact = np.array([fuzzy_lines.distance(a, b) for a, b in pairs])
    groups, inner = [], fuzzy_lines.together
    monkeypatch.setattr(fuzzy_lines, "together", lambda pairs, *args: groups.append(len(pairs)) or inner(pairs, *args))
    found = fuzzy_lines.distances(pairs, most)
    assert ((found <= most) == (exact <= most)).all() and (found[exact <= most] == exact[exact <= most]).all()
    assert 20 < (exact <= most).sum() < len(pairs) - 20 and sum(groups) > 100 and len(groups) < 8


def test_entries_and_bands_are_not_stored(spark, monkeypatch):
    """What blocks send to the parts goes there in one exchange; a table holds nodes and lists alone."""
    kept, inner = [], fuzzy_lines.stored
    monkeypatch.setattr(fuzzy_lines, "stored", lambda frame, purpose: kept.append(frame.dtypes) or inner(frame, purpose))
    got = fuzzy_lines.remove_fuzzy_lines(spark.createDataFrame([(1, "one line\none lime"), (None, "one line"), (0, "another")], "doc_id bigint, text string"))
    assert sorted((r.n_lines, r.n_removed) for r in got.collect()) == [(1, 0), (1, 1), (2, 1)]
    assert kept and not [name for frame in kept for name, kind in frame if kind == "binary" and name != "line"]


def test_the_table_of_lines_goes_once_lists_stand(spark, monkeypatch):
    gone = []
    monkeypatch.setattr(fuzzy_lines, "discarded", lambda *frames: gone.extend(frames))
    fuzzy_lines.remove_fuzzy_lines(spark.createDataFrame([(1, "one line\none lime"), (2, "one line")], "doc_id bigint, text string")).collect()
    assert [set(fuzzy_lines.NODE_NAMES) == set(frame.columns) for frame in gone] == [True]


def test_near_simhashes_of_lists_of_any_length():
    rng = np.random.default_rng(3)
    for n in (2, 511, 513, 1500):
        sims = rng.integers(0, 1 << 63, n, dtype=np.uint64) & np.uint64((1 << 48) - 1)
        for at in range(0, n - 1, 7):  # some lie up to four bits beside another
            flips = rng.choice(64, at % 5, replace=False)
            sims[at + 1] = sims[at] ^ np.bitwise_xor.reduce(np.uint64(1) << flips.astype(np.uint64), initial=np.uint64(0))
        want = [(np.bitwise_count(sims ^ sim) <= fuzzy_lines.NEAR).sum() > 1 for sim in sims]
        assert fuzzy_lines.have_near(sims).tolist() == want and any(want)


def test_simhash_votes():
    rng = np.random.default_rng(9)
    lines = [[b"w%d" % i for i in rng.choice(5000, n, replace=False)] for n in [*rng.integers(1, 200, 40), 1, 2, 200, 201, 700]]
    got = fuzzy_lines.simhashes(lines)
    for line, sim in zip(lines, got, strict=True):
        names, pairs, _ = fuzzy_lines.names_of([line])
        for bit in range(64):
            votes = sum(3 * (int(n) >> bit & 1) for n in names) + sum(int(n) >> bit & 1 for n in pairs[:-1])
            assert (int(sim) >> bit & 1) == (2 * votes > 4 * len(line) - 1)


def test_edit_distance():
    rng = np.random.default_rng(6)

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    for _ in range(300):
        a, b = (bytes(rng.choice(list(b"abc"), rng.integers(0, 14)).tolist()) for _ in range(2))
        assert fuzzy_lines.distance(a, b) == slow(a, b)

    pairs = [tuple(bytes(rng.choice(list(b"abcd"), rng.integers(0, most)).tolist()) for _ in range(2)) for most in [14] * 200 + [200] * 60 + [400] * 8]
    pairs += [(b"x" * 100, b"x" * 130), (b"", b"abc"), (b"same", b"same"), (b"a" * 64 + b"b", b"a" * 64), (b"q" * 1000, b"r" * 900 + b"q")]
    exact = np.array([slow(a, b) for a, b in pairs])
    assert fuzzy_lines.distances(pairs, np.full(len(pairs), 10_000)).tolist() == exact.tolist()
    for most in (0, 3, 40, 150):
        found = fuzzy_lines.distances(pairs, np.full(len(pairs), most))
        assert ((found <= most) == (exact <= most)).all() and (found[exact <= most] == exact[exact <= most]).all()
    near = [(a, bytes(rng.choice(list(b"abcd"), 3).tolist()) + a[5:]) for a, _ in pairs]
    first, second = zip(*pairs, *near, strict=True)
    assert fuzzy_lines.similar_pairs(list(first), list(second)).tolist() == [fuzzy_lines.similar(a, b) for a, b in zip(first, second, strict=True)]


def test_ways_between_lines(monkeypatch):
    """Lines a few edits apart are seen to be similar without their distance; a way that is found is never too short."""
    rng, first, second = random.Random(6), [], []
    word = lambda: "".join(rng.choice("abcdeinthrs") for _ in range(rng.randint(1, 9)))
    for _ in range(200):
        words = [word() for _ in range(60)]
        first.append(" ".join(words).encode())
        for at in rng.sample(range(60), 4):
            words[at] = rng.choice(["", word(), f"{words[at]} {word()}"])
        second.append(" ".join(words).encode())
    measured, inner = [], fuzzy_lines.distances
    monkeypatch.setattr(fuzzy_lines, "distances", lambda pairs, most: measured.extend(pairs) or inner(pairs, most))
    assert fuzzy_lines.similar_pairs(first, second).all() and len(measured) < 20
    for _ in range(1000):
        a = bytes(rng.choice(b"ab ") for _ in range(rng.randint(0, 60)))
        b = bytearray(a)
        for _ in range(rng.randint(0, 12)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 3)] = bytes(rng.choice(b"ab ") for _ in range(rng.randint(0, 3)))
        most = rng.randint(0, 10)
        assert fuzzy_lines.distance(a, bytes(b)) <= most or not fuzzy_lines.way_found(a, bytes(b), most)


def test_single_distances_end_early():
    """A pair of long lines that is certain to exceed its bound is left once a column does."""
    rng = random.Random(7)
    for _ in range(60):
        a, b = (bytes(rng.choice(b"abc") for _ in range(rng.randint(300, 500))) for _ in range(2))
        whole = fuzzy_lines.distance(a, b)
        for most in (20, whole - 1, whole, whole + 1):
            found = fuzzy_lines.distance(a, b, most)
            assert found == whole if whole <= most else found > most


def test_few_links_need_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(components, "are_stars", None)
    links = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 5), (2, 9)], "a long, b long")
    assert sorted(map(tuple, components.connected_components(links).collect())) == [(2, 2), (3, 3), (4, 3), (5, 3), (8, 2), (9, 2)]
    assert components.connected_components(links.where("a = b")).count() == 0


def test_components(spark):
    rng = np.random.default_rng(8)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 80, (60, 2))] + [(100 + i, 101 + i) for i in range(20)] + [(200, 200 + i) for i in range(1, 30)]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent if any(a != b and x in (a, b) for a, b in links)}


@pytest.mark.parametrize("few", [0, 50_000])
def test_components_of_few_and_many_links(spark, monkeypatch, few):
    """Few links are joined without exchanges, many with them, to the same components."""
    monkeypatch.setattr(components, "FEW_LINKS", few)
    links = spark.createDataFrame([(i, i * 7 % 101) for i in range(40)] + [(300 - i, 299 - i) for i in range(30)], "a bigint, b bigint")
    got = {r.node: r.component for r in components.connected_components(links).collect()}
    for a, b in map(tuple, links.where("a <> b").collect()):
        assert got[a] == got[b] <= min(a, b)
    one = stored(links, "links").coalesce(1)
    assert "hashpartitioning" not in components.small_star(components.large_star(one))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("run", [exact_dedup.deduplicate, jaccard_join.classes_of, recompression.remove_repeats, fuzzy_lines.remove_fuzzy_lines])
def test_empty_tables(empty, run):
    assert run(empty).count() == 0


@pytest.mark.parametrize(("words", "percent"), [(2, 50), (3, 90)])
def test_jaccard_in_rounds(spark, stored_docs, plain, monkeypatch, words, percent):
    """Rounds of a few partners a node, and lists that are dealt to parts, lose no link."""
    monkeypatch.setattr(components, "MANY", 0)
    monkeypatch.setattr(components, "DEALT", 3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.classes_of(stored_docs, words, percent).collect())
    assert got == classes(plain, percent, words)


def test_jaccard_near_copies_without_a_common_partner(spark):
    """A group whose members all differ from their base by nearly the bound, so that its links are no star."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for at in range(90):
        own = list(base)
        for place in rng.choice(60, 2, replace=False):
            own[place] = f"x{at}y{place}"
        rows.append((at, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.classes_of(docs, 3, 75).collect())
    assert got == classes(rows, 75, 3) and len({k[2] for k in got}) < 90


@pytest.mark.parametrize("stage", ["exact", "jaccard", "mixing"])
def test_clashing_names_stay(spark, tmp_path, stage):
    """Columns named as the operators' own come back as they were."""
    from agrolith.llm import mixing

    rows = [(1, "a b c d e f", 10, "x", 0.5), (2, "A b c d e f", 11, "y", None), (3, None, None, None, 1.5), (3, "other words are here now", 12, "z", 2.5)]
    schema = "doc_id bigint, text string, agrolith_row int, agrolith_file string, `_row` double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    run = {"exact": exact_dedup.keep_first, "jaccard": lambda d: jaccard_join.keep_one(d, 5, 80), "mixing": lambda d: mixing.thin(d, none)}[stage]
    out = run(docs)
    assert out.columns == docs.columns
    got = {tuple(r) for r in out.collect()}
    assert got <= set(rows) and len(got) >= 3


def test_fuzzy_lines_of_odd_tables(spark):
    """Repeated rows, very long lines, white space of all kinds, and columns of clashing names."""
    rng = np.random.default_rng(3)
    long = " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(20_000))
    other = long[:-40] + "changed at the very end of the line here"
    rows = [(1, f"{long}\nshort line of words", "x", 1), (1, f"{long}\nshort line of words", "x", 1), (2, f"  {long.upper()} \t", None, 2), (3, other, "y", 3), (4, "\n\n \x0b\n", "z", 4), (5, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, line string, node int")
    got = sorted((r.doc_id, r.n_lines, r.n_removed) for r in fuzzy_lines.remove_fuzzy_lines(docs).collect())
    assert got == [(1, 2, 0), (1, 2, 2), (2, 1, 1), (3, 1, 1), (4, 4, 0), (5, 0, 0)]


def test_windows_that_only_share_a_fingerprint(monkeypatch):
    """Fingerprints that collide stop the job instead of removing words."""
    real = recompression.fingerprints
    monkeypatch.setattr(recompression, "fingerprints", lambda names, width, base: real(names, width, base) * np.uint64(0) if width == recompression.WINDOW else real(names, width, base))
    with pytest.raises(ValueError, match="share a fingerprint"):
        words = [f"w{i}" for i in range(80)]
        for _ in recompression.share_windows(iter([recompression.pa.RecordBatch.from_arrays([recompression.pa.array([0]), recompression.pa.array([" ".join(words)]), recompression.pa.array([np.arange(80, dtype="<u4").tobytes()])], ["row", "text", "places"])]), 3):
            pass


def test_runs_merge():
    runs = recompression.runs_of(np.array([5, 5, 5, 5, 7]), np.array([3, 4, 9, 5, 0]), np.array([1, 1, 1, 1, recompression.NOWHERE]), np.array([10, 11, 16, 12, 0]))
    assert [tuple(int(x) for x in r) for r in runs] == [(5, 3, 3, 1, 10), (5, 9, 1, 1, 16), (7, 0, 1, -1, 0)]
    more = recompression.runs_of(np.array([5, 5, 5]), np.array([6, 7, 8]), np.array([1, 1, 1]), np.array([13, 14, 15]))
    merged = recompression.merged(np.concatenate([runs, more]))
    assert [tuple(int(x) for x in r) for r in merged] == [(5, 3, 7, 1, 10), (7, 0, 1, -1, 0)]
