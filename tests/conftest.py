import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from shopscope.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

# Hand-made rows (FIXTURES.md): shops, then payments. Invented to reach each
# rule once: a blank per_pay, a blank score, a nine-field line, a category
# only in the third column, an unknown shop id, a leading blank in a time.
SHOP_LINES = [
    "1,北京,10,80,4,12,2,美食,火锅,重庆火锅",
    "2,上海,11,50,5,,2,美食,火锅,",
    "3,广州,12,,3,1,1,美食,小火锅,",
    "4,杭州,13,60,5,1,1,美食,火锅,",
    "5,北京,14,30,,3,1,超市便利店,超市,",
    "6,上海,15,120,2,9,3,美食,其他,火锅",
    "7,广州,16,100,3,2,1,火锅,,麻辣",
]

PAY_LINES = [
    "u1,1,2016-01-01 10:00:00",
    "u2,1,2016-01-01 11:00:00",
    "u3,1,2016-01-02 09:00:00",
    "u1,2,2016-01-01 12:00:00",
    "u2,2, 2016-01-03 12:00:00",
    "u1,3,2016-01-01 12:00:00",
    "u4,4,2016-01-01 08:00:00",
    "u4,4,2016-01-01 09:00:00",
    "u5,4,2016-01-02 09:00:00",
    "u6,4,2016-01-03 09:00:00",
    "u7,4,2016-01-04 09:00:00",
    "u5,5,2016-02-01 00:00:00",
    "u6,7,2016-01-01 00:00:00",
    "u7,7,2016-01-01 00:00:01",
    "u8,7,2016-01-01 23:59:59",
    "u9,7,2016-01-05 10:00:00",
    "u9,99,2016-01-05 10:00:00",
]

VIEW_LINES = [
    "u1,1,2016-01-01 09:00:00",
    "u2,7,2016-01-02 10:30:00",
    "u3,4,2016-01-03 11:45:00",
]


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        app_name="shopscope-tests",
        shuffle_partitions=8,
        conf={"spark.sql.session.timeZone": "UTC"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def write_lines(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="session")
def fixture_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("fixtures")
    write_lines(d / "shop_info.txt", SHOP_LINES)
    write_lines(d / "user_pay.txt", PAY_LINES)
    write_lines(d / "user_view.txt", VIEW_LINES)
    # The same rows as JSON lines; integers alternate between quoted and bare.
    shop_json = []
    cols = ["shop_id", "city_name", "location_id", "per_pay", "score", "comment_cnt", "shop_level",
            "cate_1_name", "cate_2_name", "cate_3_name"]
    for i, line in enumerate(SHOP_LINES):
        parts = line.split(",")
        parts += [""] * (10 - len(parts))
        rec = {}
        for j, (c, v) in enumerate(zip(cols, parts)):
            if 2 <= j <= 6 and v != "" and (i + j) % 2 == 0:
                rec[c] = int(v)
            else:
                rec[c] = v
        shop_json.append(json.dumps(rec, ensure_ascii=False))
    write_lines(d / "shop_info.json", shop_json)
    log_cols = ["user_id", "shop_id", "time_stamp"]
    write_lines(d / "user_pay.json",
                [json.dumps(dict(zip(log_cols, ln.split(","))), ensure_ascii=False) for ln in PAY_LINES])
    write_lines(d / "user_view.json",
                [json.dumps(dict(zip(log_cols, ln.split(","))), ensure_ascii=False) for ln in VIEW_LINES])
    return d


@pytest.fixture(scope="session")
def tables(spark, fixture_dir):
    from shopscope.sources import read_tables

    return read_tables(spark, str(fixture_dir / "shop_info.txt"), str(fixture_dir / "user_pay.txt"),
                       str(fixture_dir / "user_view.txt"))
