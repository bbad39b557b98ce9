import random

import pytest

WORDS = "the of and to in that it with as for on by from this be are was an at or ti re en er nd th ou ing tion ent".split()


@pytest.fixture(scope="session")
def texts():
    """Invented texts with exact and near copies, shared passages, empty, null and long ones."""
    rng = random.Random(3)
    word = lambda: rng.choice(WORDS) + rng.choice(WORDS) + rng.choice(["", ",", "."])
    base = [" ".join(word() for _ in range(rng.randint(1, 160))) for _ in range(60)]
    passage = " ".join(word() for _ in range(60))
    out = list(base)
    out += [base[1], base[1], base[2].upper(), base[3]]
    for at in range(4, 14):  # near copies: one or two words changed
        own = base[at].split()
        for _ in range(3):
            copy = list(own)
            copy[rng.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
    out += [f"{word()} {word()} {passage} {word()}" for _ in range(5)]
    out += [None, "", "   \n\t ", "one", "one two", "É é Ünï 𝕏 ß x", "a\nb\n\nc\n", " ".join(["same"] * 120), " ".join(word() for _ in range(3000))]
    small = [word() for _ in range(14)]
    out += [" ".join(small), " ".join([*small, "more"]), " ".join(["less", *small])]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with a null in every column, a repeated row, a repeated doc_id and a column of a clashing name."""
    rows = [(at, text, "en", f"src{at % 3}", None if at % 5 else len(text or ""), "x") for at, text in enumerate(texts)]
    rows += [(None, "no number", None, None, None, None), rows[5], (6, "another text of the same number", "en", "s", 1, "y")]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string"
    return spark.createDataFrame(rows, schema).repartition(3).sortWithinPartitions("doc_id", "text")


@pytest.fixture(scope="session")
def stored_docs(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    docs.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def plain(stored_docs):
    """The rows as (doc_id, text)."""
    return [(r.doc_id, r.text or "") for r in stored_docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(stored_docs):
    return stored_docs.limit(0)
