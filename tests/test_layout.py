import pytest
from hypothesis import given
from hypothesis import strategies as st

from corpusloom.functions.text import ENGLISH_WORDS
from corpusloom.operators import layout

EN = [f"this is sentence {i} and it was written for the test" for i in range(8)]
FR = [f"phrase {i} une autre langue qui parle aussi" for i in range(8)]
HI = [f"यह वाक्य {i} परीक्षण के लिए है" for i in range(8)]


@pytest.fixture(scope="module")
def frame(spark):
    def make(**columns):
        rows = [(i, *r) for i, r in enumerate(zip(*columns.values(), strict=True))]
        return spark.createDataFrame(rows, ["_order", *columns])

    return make


def found(df):
    r = layout.resolve_columns(df, "_order")
    return r["id"], r["english"], r["target"]


@pytest.mark.parametrize(("a", "b"), [("english", "target"), ("src", "tgt"), ("SOURCE", "TRANSLATE"), ("en", "hi"), ("Source Text", "Nepali")])
def test_headers_settle_it(frame, a, b):
    assert found(frame(**{"SN": range(8), a: EN, b: FR})) == ("SN", a, b)


def test_a_foreign_script_is_the_target(frame):
    assert found(frame(p=HI, q=EN)) == (None, "q", "p")
    assert found(frame(k=[f"r{i}" for i in range(8)], p=HI, q=EN)) == ("k", "q", "p")


def test_english_words_decide_between_latin_columns(frame):
    assert found(frame(p=FR, q=EN)) == (None, "q", "p")


def test_a_short_unique_column_is_no_english_side(frame):
    """A string id under an unknown header stands before the text."""
    assert found(frame(code=[f"ab-{i}" for i in range(8)], p=HI, q=EN))[1:] == ("q", "p")


def test_headerless_two_columns_either_way(frame):
    assert found(frame(c0=EN, c1=HI)) == (None, "c0", "c1")
    assert found(frame(c0=HI, c1=EN)) == (None, "c1", "c0")


def test_a_header_is_not_overruled(frame):
    assert found(frame(english=FR, other=EN)) == (None, "english", "other")
    assert found(frame(one=EN, french=FR)) == (None, "one", "french")


def test_unclear_layouts_are_refused(frame):
    with pytest.raises(layout.DetectionError, match="can't tell"):
        found(frame(p=EN, q=EN))
    with pytest.raises(layout.DetectionError):
        found(frame(a=FR, b=FR, c=FR))


def test_headerless_rows():
    assert layout.headerless(["Unnamed: 0", "Unnamed: 1"])
    assert layout.headerless(["x" * 61, "y"]) and layout.headerless(["यह वाक्य", "a b"])
    assert not layout.headerless(["english", "नेपाली"]) and not layout.headerless(["a", "b"])


def test_profile_counts(frame):
    df = frame(p=["the cat", "“quoted”", None, "  ", "naïve café", "x", "x", "y"])
    (p,) = layout.profiles(df, "_order")
    assert (p.n, p.unique, p.longest) == (6, False, 10)
    assert p.non_latin == pytest.approx(1 / 6) and p.english == pytest.approx(1 / 6)


@given(st.text(max_size=30))
def test_normal_names(name):
    got = layout.normal(name)
    assert all(c in "abcdefghijklmnopqrstuvwxyz0123456789" for c in got) and layout.normal(got) == got


def test_fixed_values():
    assert len(layout.LANGUAGE_NAMES) == 88 and len(layout.ID_NAMES) == 16 and len(layout.ENGLISH_NAMES) == 13 and len(layout.TARGET_NAMES) == 10
    assert len(set(ENGLISH_WORDS)) == len(ENGLISH_WORDS)
