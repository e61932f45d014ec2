"""Small tables with every awkward case, for all operators of the subpackage."""

import random

import pytest

SYLLABLES = "an the er in re th on ti es or st ed nd he at ou en ha le ing".split()
EXTRA = "n node family class kind hashes removed component_id score item group bucket slice words lang_pred votes length rank"


def sentence(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


def text_of(rng, lines, words=14):
    return "\n".join(sentence(rng, words) for _ in range(lines))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): nulls, empties, short and very long texts, ties, repeated rows, exact and near copies, symbols, scripts."""
    rng = random.Random(5)
    base = [text_of(rng, rng.randint(2, 9)) for _ in range(24)]
    rows = list(enumerate(base))
    long_ = base[3].split()
    near = base[5].split(" ")
    near[7] = "changed"
    more = [
        None,
        "",
        " \t\n ",
        "one",
        "one",
        "ONE",
        "two words",
        "Two words",
        "a b c",
        base[0],
        base[0].upper(),
        base[1] + "\n" + base[2].split("\n")[0],
        " ".join(near),
        "café Été naïve 漢字   é 😀 ß",
        "x" * 5000,
        "Un " * 200,
        "\n".join(["Again and again the same line stands here."] * 6),
        text_of(rng, 800, 20),
        " ".join(long_ * 40),
        "%%% ### $$$ &&& " * 30,
        base[4][:-1] + "!",
        base[4].replace("the", "thx", 1),
    ]
    rows += [(100 + i, t) for i, t in enumerate(more)]
    rows += [(3, base[3]), (100, None), (None, base[6]), (None, None), (None, "nobody knows this one but me and you and them all")]
    return rows


@pytest.fixture(scope="session")
def awkward(spark, texts):
    """The texts with columns whose names the operators use inside, and one that repeats a result's name in other case."""
    names = EXTRA.split()
    rows = [(i, t, "en" if k % 3 else None, f"src{k % 2}", len(t or ""), *[k] * len(names)) for k, (i, t) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{n}` int" for n in names)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
