import json
import time

import pytest
from pyspark.sql import functions as F

from loomspar.functions import documents, fuzzy, repair
from loomspar.functions import scalars as S
from loomspar.sources import readers


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "value"),
    [("42", 42.0), (" 1e3 ", 1000.0), ("0x10", 16.0), ("0b11", 3.0), ("0o17", 15.0), ("-0", 0.0), (".5", 0.5), ("5.", 5.0), ("", None), ("1d", None), ("Infinity", None), ("1 2", None), (None, None)],
)
def test_numbers(spark, text, value):
    assert one(spark, S.to_number(F.lit(text).cast("string"))) == value


@pytest.mark.parametrize(("n", "day"), [(1, "1900-01-01"), (59, "1900-02-28"), (60, "1900-03-01"), (61, "1900-03-01"), (45744, "2025-03-28"), (0, None), (-3, None)])
def test_serial_dates(spark, n, day):
    assert one(spark, F.date_format(S.serial_date(F.lit(float(n))), "yyyy-MM-dd")) == day


@pytest.mark.parametrize(("n", "day"), [(45744.5, "2025-03-28"), (2958465, "9999-12-31"), (2958466, "10000-01-01"), (8999995.5, "26541-02-22"), (40000000, "111416-04-11"), (0, None)])
def test_serial_days_beyond_9999_bear_no_sign(spark, n, day):
    assert one(spark, S.day_text(S.serial_date(F.lit(float(n))))) == day


@pytest.mark.parametrize(("text", "day"), [("2025-01-31", "2025-01-31"), ("2025-02-30", None), ("2025-01-31T23:00:00-05:00", None), ("2025-01-31T10:00:00Z", "2025-01-31"), ("31/01/2025", None), ("", None)])
def test_dates(spark, text, day):
    assert one(spark, S.iso_date(F.lit(text))) == day


@pytest.mark.parametrize(
    ("text", "stamp"),
    [("2025-01-31", "2025-01-31T00:00:00.000+0000"), ("2025-01-31T10:30", "2025-01-31T10:30:00.000+0000"), ("2025-01-31T10:30:05.25+0200", "2025-01-31T08:30:05.250+0000"), ("2025-02-30T00:00:00Z", None), ("x", None)],
)
def test_date_times(spark, text, stamp):
    assert one(spark, S.iso_datetime(F.lit(text))) == stamp


@pytest.mark.parametrize(("s", "text"), [(0, "0m"), (59, "0m"), (60, "1m"), (8 * 3600, "1d"), (5 * 8 * 3600 + 3600, "1w 1h"), (-1, None)])
def test_durations(spark, s, text):
    assert one(spark, S.duration_text(F.lit(s))) == text


@pytest.mark.parametrize(("text", "value"), [("2 hours", "2h"), ("1w 2d", "1w 2d"), ("30 Min", "30m"), ("1W", "1w"), ("soon", None), ("2 hours 5", None)])
def test_duration_values(spark, text, value):
    assert one(spark, S.duration_value(F.lit(text))) == value


@pytest.mark.parametrize(("text", "parent", "child"), [("a -> b", "a", "b"), ("a/b->c", "a/b", "c"), ("x, y", "x", "y"), ("lone  one", None, "lone one"), ("a > b", "a", "b"), ("-> b", "-", "b")])
def test_cascades(spark, text, parent, child):
    got = one(spark, S.split_cascade(F.lit(text)))
    assert (got.parent, got.child) == (parent, child)


@pytest.mark.parametrize(
    ("pattern", "text"), [("MS7 2025", "PROJ_MS7_2025"), ("code automation", "Code - Automation"), ("p1 critical", "P1 - Critical"), ("automaton", "Code - Automation"), ("apartmnt", "mp_apartment"), ("critcal", "P1 - Critical")]
)
def test_fuzzy_accepts(pattern, text):
    assert 0 < fuzzy.score(pattern, text) <= 0.3


def test_fuzzy_scores():
    assert fuzzy.score("Same", "sAME") == 0.0
    assert fuzzy.score("zzz", "abc") is None
    assert fuzzy.score("a" * 40, "b" * 40) is None
    assert fuzzy.item_score("alpha", ["alpha", None]) < fuzzy.item_score("alpha", ["alphb", None])
    late = fuzzy.Options(threshold=0.4, ignore_place=False, least_run=1)
    assert fuzzy.score("ring", "ring x", late) < fuzzy.score("ring", "a blue ring", late)


def test_yaml_repair():
    assert repair.yaml_quotes('a: "say "hi" now"\nb: 1').output == 'a: "say \\"hi\\" now"\nb: 1'
    assert repair.yaml_quotes("a: 'it's'\r\nb: 1").output == "a: 'it''s'\r\nb: 1"
    assert repair.yaml_quotes('a: "one\ntwo "x"\nthree"').output == 'a: "one\ntwo \\"x\\"\nthree"'
    assert not repair.yaml_quotes("a: b").modified
    assert repair.yaml_quotes('- "open').output == '- "open"'


def test_json_repair():
    assert json.loads(repair.json_quotes('{"a": "x "y" z", "b": 1}').output) == {"a": 'x "y" z', "b": 1}
    assert json.loads(repair.json_quotes("{'a': 'b'}").output) == {"a": "b"}
    assert json.loads(repair.json_quotes('["p "q" r", "s"]').output) == ['p "q" r', "s"]
    assert not repair.json_quotes('{"a": "b"}').modified


def test_csv_repair():
    assert readers.parse_csv(repair.csv_quotes('a,b\n1,"x "y" z"\n').output) == [{"a": "1", "b": 'x "y" z'}]
    assert readers.parse_csv(repair.csv_quotes('a,b\nx "y",2').output) == [{"a": 'x "y"', "b": "2"}]


def test_no_field_is_swallowed():
    assert json.loads(repair.json_quotes('{"a": "the "x", and "y" z", "b": "c"}').output) == {"a": 'the "x", and "y" z', "b": "c"}
    assert json.loads(repair.json_quotes('{"a": "p", "b": "q "r", s", "c": ["t "u" v", 1], "d": {"e": "f "g""}, "h": "i"}').output) == {
        "a": "p", "b": 'q "r", s', "c": ['t "u" v', 1], "d": {"e": 'f "g"'}, "h": "i",
    }
    got = readers.parse_csv(repair.csv_quotes('a,b,c\n1,"x "big", red" y",2\n"3","p","q "r" s"\n"4","say ""hi"", ok","z"\n').output)
    assert [list(r.values()) for r in got] == [["1", 'x "big", red" y', "2"], ["3", "p", 'q "r" s'], ["4", 'say "hi", ok', "z"]]
    assert readers.parse_csv(repair.csv_quotes('a,b\n1,"one\ntwo"\n2,"x "y" z"').output) == [{"a": "1", "b": "one\ntwo"}, {"a": "2", "b": 'x "y" z'}]


@pytest.mark.parametrize("fmt", ["json", "csv", "yaml"])
def test_a_megabyte_is_repaired_in_seconds(fmt):
    n = 30000
    parts = {"json": ('{"k%d": "the "x%d", and "y" z"}', "[", ",", "]"), "csv": ('%d,"the "x%d", and "y" z"', "a,b\n", "\n", ""), "yaml": ('k%d: "the "x%d", and "y" z" # c', "", "\n", "")}
    one, head, between, tail = parts[fmt]
    text = head + between.join(one % (i, i) for i in range(n)) + tail
    start = time.perf_counter()
    out = repair.QUOTES[fmt](text).output
    assert time.perf_counter() - start < 5
    rows = readers.PARSERS[fmt](out)
    assert len(rows) == (1 if fmt == "yaml" else n)
    last = rows[-1].get(f"k{n - 1}", rows[-1].get("b"))
    assert last == f'the "x{n - 1}", and "y" z'


@pytest.mark.parametrize("text", ['{"a": "' + '"' * 200000, '{"a": "' + 'x" ' * 100000, "['" + "', " * 100000, '{"a' * 100000, '"' * 300000, 'a,b\n"' + 'x" ,"' * 60000, "a: '" + "'" * 200000])
def test_broken_text_ends_in_time(text):
    for fn in repair.QUOTES.values():
        start = time.perf_counter()
        fn(text)
        assert time.perf_counter() - start < 5


def test_scalars_and_constants():
    assert readers.parse("a: 12:30:45\nb: 010\nc: 0o10\nd: 0x1F\ne: 1.5e3\nf: -7\ng: .5\nh: 1_000\ni: 1e3\nj: 2024-01-02\nk: '3'\n", "yaml") == [
        {"a": "12:30:45", "b": 10, "c": 8, "d": 31, "e": 1500.0, "f": -7, "g": 0.5, "h": 1000, "i": 1000.0, "j": "2024-01-02", "k": "3"}
    ]
    for text in ('{"a": NaN}', "[Infinity]"):
        with pytest.raises(ValueError, match="is no JSON value"):
            readers.parse(text, "json")
    with pytest.raises(ValueError, match="line 1 column 6"):
        readers.parse_json('{"a":}')


def test_quotes_around_blocks():
    assert readers.parse('{"a": "the "x" ring", "b": <<<\nsay "hi"\n>>>}', "json") == [{"a": 'the "x" ring', "b": 'say "hi"'}]
    assert readers.parse('a: "the "x" ring"\nb: <<<\nq: "z\n>>>', "yaml") == [{"a": 'the "x" ring', "b": 'q: "z'}]


def test_blocks():
    assert readers.parse("a: <<<\nx: \"1\"\n\\d\n>>>\nb: 2", "yaml") == [{"a": 'x: "1"\n\\d', "b": 2}]
    assert readers.parse("a,b\n1,<<<\nx\n>>>\n", "csv") == [{"a": "1", "b": "x"}]
    assert repair.custom_blocks("a: <<<\n>>>", "yaml") == 'a: ""'


def test_csv_nulls():
    assert readers.parse("a,b,c\n1,,\"\"\n", "csv") == [{"a": "1", "b": None, "c": ""}]
    assert readers.parse("", "csv") == []


def test_plain_yaml_is_read_by_the_parser_in_c_with_the_same_results():
    import random

    import yaml

    def read(text, loader):
        try:
            return repr(list(yaml.load_all(text, loader)))
        except (yaml.YAMLError, ValueError) as e:
            return isinstance(e, yaml.YAMLError)

    bits = ["a", "b: ", ": ", "- ", "-", "\n", "\n", "\n  ", " ", "---\n", "'", '"', '\\"', "text: ", "0x1f", "1_0", "yes", "~", "<<: ", "=", "2024-13-02", ".5", "--- a", "..", "k:\n", "''"]
    rnd, plain = random.Random(3), 0
    for _ in range(1500):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14)))
        base = repair.yaml_base(text)
        plain += base is not yaml.SafeLoader
        assert read(text, base) == read(text, yaml.SafeLoader) and read(text, readers._yaml_loader(base)) == read(text, readers._yaml_loader(yaml.SafeLoader)), text
    assert plain > 1000 or not yaml.__with_libyaml__
    assert all(repair.yaml_base(t) is yaml.SafeLoader for t in ("a: [1]", "a: &x 1", "a\t: 1", "a: \u00e9", "a: |\n b", "a\n...\nb", "... ", "a: \"\\x41\"", "a # b", "{a: 1}"))


def test_texts_of_one_small_file_are_dealt_out(spark):
    one = spark.range(400).coalesce(1).selectExpr("CAST(id AS string) AS source", "'yaml' AS fmt", "'text: \"a \"' || id || '\" b\"' AS text")
    out = readers.parse_texts(one)
    got = {r.source: (r.row_index, r.raw, r.error) for r in out.collect()}
    assert got == {str(i): (0, json.dumps({"text": f'a "{i}" b'}), None) for i in range(400)}
    assert "Exchange hashpartitioning(" in out._jdf.queryExecution().executedPlan().toString()


def test_repeated_texts_keep_their_own_sources():
    same = [readers._records(s, "- a: 1\n- a: 2", "yaml", {"blocks": True, "quotes": True, "always": False}) for s in ("x", "y")]
    assert same == [[(s, 0, '{"a": 1}', None), (s, 1, '{"a": 2}', None)] for s in ("x", "y")]
    assert readers._records("z", "a: b: c", "yaml", {"blocks": True, "quotes": True, "always": False})[0][3] is not None


def test_json_and_yaml():
    assert readers.parse('{"a": "x\ny"}', "json") == [{"a": "x\ny"}]
    assert readers.parse("a: yes\n---\n- b: 2024-01-02\n---\n", "yaml") == [{"a": "yes"}, {"b": "2024-01-02"}]
    with pytest.raises(ValueError):
        readers.parse("3", "json")


def test_tree_round_trip():
    text = "# T\n\n- a **b**\n- c\n\n1. x\n\npara `code`\nline\n```py\nz\n```"
    tree = documents.to_tree(text)
    assert [n["type"] for n in tree["content"]] == ["heading", "bulletList", "orderedList", "paragraph", "codeBlock"]
    assert documents.is_tree(tree) and not documents.is_tree({"type": "doc"})
    assert documents.to_plain(tree) == "T\n\n- a b\n- c\n\n1. x\n\npara code\nline\n\nz"
    assert documents.to_tree("  ")["content"] == [{"type": "paragraph", "content": []}]


def test_sanitize():
    assert repair.sanitize({" k​": [" a ", 1, None]}) == {"k": ["a", 1, None]}
