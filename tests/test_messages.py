import os

from backdrop.sources import messages as MSG


def test_json_lines_file(spark, tmp):
    path = os.path.join(tmp, "feed")
    os.makedirs(path)
    with open(os.path.join(path, "a.txt"), "w", encoding="utf-8") as fh:
        fh.write('{"message": "Hello, this is a test message."}\n')
        fh.write('{"message": "xin chào"}\n')
        fh.write("\n")
        fh.write("not json\n")
    rows = MSG.read_messages(spark, path).collect()
    assert [r["message"] for r in rows] == ["Hello, this is a test message.", "xin chào", None]


def test_encode_then_parse(spark):
    df = spark.createDataFrame([("a \"quoted\" text",), ("ü",)], "message string")
    lines = MSG.encode_messages(df)
    back = MSG.parse_json_lines(lines, "value").select("message").collect()
    assert [r["message"] for r in back] == ["a \"quoted\" text", "ü"]
