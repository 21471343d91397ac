from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def _texts() -> list[str | None]:
    """Edge cases first, then prose with copies, near copies, shared lines and shared passages."""
    pick = random.Random(11)
    vocabulary = ["the", "of", "and", "straße", "élan", "niño", "über", "was", "in", "to"] + ["".join(pick.choice("abcdefghij") for _ in range(pick.randint(3, 9))) for _ in range(150)]
    prose = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    passage, line = prose(60), "All rights of this line are shared by many."
    out: list[str | None] = [None, "", " ", "\n\n", "a", "Two words", "###", "'s don't  \t x", "á" * 300, "ab" * 400, "中文字 и по-русски ok", "1 2 3\r\nx\x0b\x0cy <|endoftext|> z", prose(6000)]
    for i in range(30):
        body = [prose(pick.randint(5, 40)) for _ in range(pick.randint(1, 6))]
        if i % 3 == 0:
            body.insert(pick.randint(0, len(body)), f"  {line.upper()}\t" if i % 2 else line)
        if i % 4 == 0:
            body.append(prose(9) + " " + passage + " " + prose(9))
        out.append("\n".join(body))
    out += [out[-1], out[-1], out[-2] + " more", prose(400)]
    out.append(out[-1].replace(" the ", " and ", 1))
    return out


@pytest.fixture(scope="session")
def texts():
    return _texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with repeated rows, a null in each column and an extra column with a clashing name."""
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[20], rows[20]], DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Columns that operators might use for themselves, and a null doc_id."""
    return spark.createDataFrame([(None, "Some text here.\nSome text here.", "x", 1, 2), (7, None, None, None, None)], "doc_id long, text string, fp string, key long, n long")


#: Names that operators used, or might use, for themselves.
CLASHES = ("row", "id", "its", "hash", "gone", "salt", "h1", "h2", "k1", "k2", "f1", "fp", "root", "component_id", "pos", "keep", "seq", "words", "restart", "c0", "batch", "__id", "__text", "__row", "__drop", "__key", "a b", "x`y", "u.v")


@pytest.fixture(scope="session")
def clashing(spark):
    """Three rows that share a long line, the first two equal, with every clashing name as a further column."""
    line = "This line of many letters is in each of them."
    texts = [f"{line}\nalpha beta gamma delta epsilon", f"{line}\nalpha beta gamma delta epsilon", f"{line}\nquite other words stand in this third row here"]
    kind = ", ".join(f"`{c.replace('`', '``')}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, *(f"{c}{i}" for c in CLASHES)) for i, t in enumerate(texts)], f"doc_id long, text string, {kind}")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def tables(spark, tmp_path):
    """Write tables as a data folder and return its path."""

    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
