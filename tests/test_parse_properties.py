"""Line parsing against a plain-Python statement of the original rules.

Examples are derandomized, so every run checks the same cases. To explore
further, set derandomize=False (and a larger max_examples); ten random
seeds of the settings below passed before they were fixed.
"""

import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shopscope.sources.lines import parse_pay_lines, parse_shop_lines

INT_FIELDS = (2, 3, 4, 5, 6)


def java_split(line: str) -> list[str]:
    """String.split(","): no match -> the whole text; trailing empties dropped."""
    if "," not in line:
        return [line]
    parts = line.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_int(text: str):
    """Blank -> 0; otherwise Integer.parseInt, or None where it would throw."""
    if text == "":
        return 0
    sign, body = 1, text
    if text[0] in "+-":
        sign, body = (-1 if text[0] == "-" else 1), text[1:]
    if not body or not all(ord(ch) < 0x10000 and unicodedata.category(ch) == "Nd" for ch in body):
        return None
    value = sign * int("".join(str(unicodedata.digit(ch)) for ch in body))
    return value if -(2 ** 31) <= value < 2 ** 31 else None


def expected_shop(line: str):
    f = java_split(line)
    if len(f) < 9:
        return None
    ints = [java_int(f[i]) for i in INT_FIELDS]
    if any(v is None for v in ints):
        return None
    return (f[0], f[1], *ints, f[7], f[8], f[9] if len(f) > 9 else "")


FIELD = st.one_of(
    st.just(""),
    st.integers(-(2 ** 33), 2 ** 33).map(str),
    st.sampled_from(["+7", "-0", "１２", "٣", " 5", "5 ", "\t", "4x", "+", "火锅", "北京"]),
    st.text(alphabet="ab1 -+火\t", max_size=4),
)
LINE = st.lists(FIELD, min_size=0, max_size=12).map(",".join)


@settings(max_examples=25, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines=st.lists(LINE, min_size=1, max_size=40))
def test_shop_lines_match_rules(spark, lines):
    df = spark.createDataFrame([(ln,) for ln in lines], "value string")
    got = parse_shop_lines(df, bad_rows="keep").collect()
    assert len(got) == len(lines)
    want = {}
    for ln in lines:
        want.setdefault(ln, expected_shop(ln))
    for row in got:
        if row["_bad"] is not None:
            assert want[row["_bad"]] is None, row["_bad"]
        else:
            values = tuple(row[c] for c in row.__fields__ if c != "_bad")
            assert values in {w for w in want.values() if w is not None}, values
    assert sum(r["_bad"] is None for r in got) == sum(expected_shop(ln) is not None for ln in lines)


@settings(max_examples=15, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines=st.lists(st.lists(st.sampled_from(["u1", "", " 2016-01-03 12:00:00", "2016-01-03", "\t2016-01-0",
                                                "s9", "2016-01-03 12:00:00\t"]), max_size=5).map(",".join),
                      min_size=1, max_size=30))
def test_pay_lines_match_rules(spark, lines):
    df = spark.createDataFrame([(ln,) for ln in lines], "value string")
    got = sorted((r.user_id, r.shop_id, r.time_stamp, r.day) for r in parse_pay_lines(df, bad_rows="drop").collect())
    want = []
    for ln in lines:
        f = java_split(ln)
        if len(f) >= 3:
            t = f[2]
            tt = t.strip("".join(chr(i) for i in range(33)))
            want.append((f[0], f[1], t, tt[:10] if len(tt) > 10 else t))
    assert got == sorted(want)
