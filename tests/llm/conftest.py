import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import functions as F  # noqa: E402

WORDS = ["lo", "rem", "ip", "sum", "do", "lor", "sit", "amet", "con", "sec", "te", "tur", "a", "di", "pis", "cing", "é", "Ünd", "漢字", "e,l.it"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    r = random.Random(seed)
    words = [r.choice(WORDS) + r.choice(WORDS) + str(r.randint(0, 30) or "") for _ in range(n)]
    return " ".join(w + ("\n" if r.random() < 0.1 else "") for w in words)


def rows():
    """(doc_id, text): plain texts, copies, near copies, nulls, empty texts, a very long text, repeated rows and ids."""
    base = [prose(i, 120) for i in range(12)]
    out = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base[:5]):
        w = t.split(" ")
        w[60] = "changed"
        out += [(20 + i, " ".join(w)), (30 + i, t.upper()), (40 + i, t)]
    out += [(50, None), (51, ""), (52, " \n\t "), (53, "one two"), (54, "One  TWO"), (55, "x" * 50_000), (56, prose(99, 20_000)),
            (57, "word " * 300), (7, base[7]), (7, base[7]), (8, prose(500, 90)), (None, base[9]), (None, None), (None, prose(501, 80))]
    return out


@pytest.fixture()
def docs(spark):
    """The rows, with columns whose names the operators use inside."""
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows()], DOCS)
    clash = {c: F.lit(1) for c in ("id", "t", "n", "c", "node", "key", "words", "text_hash", "w", "size", "shard", "start", "label", "kept", "row")}
    return frame.withColumns(clash).repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    """Words of a text as the operators define them: ASCII white space apart, A-Z folded."""
    return [w.decode() for w in (text or "").encode().lower().split()]
