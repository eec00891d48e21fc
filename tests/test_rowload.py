from conftest import rows

from papyrine.operators.rowload import load_records

GOOD = [
    "1,15,26,2,admin,4,1,Name | X", "14,13,0,0,empty,,,", '"7","23","14","2","admin","2","0","a ""b"", c\nd"', "01,1,0,200,data,0,0,", '1,1,1,1,"prose",,,""', "1,1,1,000200,data,1,1,x",
]
BAD = {
    None: "null", "": "blank", "  \n": "blank", "1": "fields missing after 1", "0,1,1,1,data,1,1,x": "field 1: doc_id", "1,1,1,201,data,1,1,x": "field 4: n_cols", "1,1,1,1,DATA,1,1,x": "field 5: verdict",
    "1,1,1,1,data,1,1": "fields missing after 7", "1,1,1,1,data,1,1,x,y": "more than 8 fields", '1,1,1,1,data,1,1,x"y': "field 8: preview", '1,1,1,1,data,1,1,"x': "field 8: preview",
    '1,1,1,1,data,1,1,"a "b" c"': "field 8: preview", '1,1,1,1,data,1,1,"a",': "more than 8 fields", '1,1,1,1,da"ta,1,1,x': "field 5: verdict", "1,1,+1,1,data,1,1,x": "field 3: n_rows", "1,1,1.0,1,data,1,1,x": "field 3: n_rows", "١,1,1,1,data,1,1,x": "field 1: doc_id",
}


def test_good_and_bad(spark):
    texts = GOOD + list(BAD)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(0, GOOD[0], "again")], "rec_id long, raw string, reason string")
    good, bad = load_records(df, "rec_id", "raw")
    assert sorted(r["rec_id"] for r in good.collect()) == list(range(len(GOOD)))
    found = {r["raw"]: r["reason"] for r in bad.collect()}
    assert found.keys() == BAD.keys()
    assert found == BAD
    typed = {r["rec_id"]: r for r in good.collect()}
    assert typed[2]["preview"] == 'a "b", c\nd' and typed[1]["admin_score"] is None and typed[3]["doc_id"] == 1


def test_long_and_empty(spark):
    long = '1,1,1,1,data,1,1,"' + '""' * 200_000 + '"'
    wide = ["9" * 30 + ",1,1,1,data,1,1,x", '1,1,"2147483648",1,data,1,1,x', "1,1,1,1,data,,99999999999,x"]
    df = spark.createDataFrame([(1, long), (2, long + "x"), (6, "1,2147483647,1,1,data,,,12345678901"), *enumerate(wide, 3)], "rec_id long, raw string")
    good, bad = load_records(df, "rec_id", "raw")
    assert {r["rec_id"]: r["start_line"] for r in good.collect()} == {1: 1, 6: 2147483647}
    reasons = ["field 1: doc_id beyond the range of bigint", "field 3: n_rows beyond the range of int", "field 7: data_score beyond the range of int"]
    assert {r["rec_id"]: r["reason"] for r in bad.collect()} == {2: "field 8: preview", **dict(enumerate(reasons, 3))}
    good, bad = load_records(df.where("false"), "rec_id", "raw")
    assert rows(good) == rows(bad) == []
