"""JSON lines of any shape: what is kept, what is rejected, and how types are found."""

import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from purchase_signals.__main__ import main
from purchase_signals.plans import load_json, load_lines, read_loaded, read_rejected, sample_json
from purchase_signals.schema import REVIEW_SCHEMA
from purchase_signals.sources import json_variant
from purchase_signals.sources.json_variant import inferred_schema, variant_lines


def write(tmp_path, lines, name="in.json"):
    path = tmp_path / name
    path.write_text("\n".join(["[", *[f"  {line}," for line in lines], "", "]"]) + "\n", encoding="utf-8")
    return str(path)


def schema_of(spark, tmp_path, *documents):
    path = write(tmp_path, [d if isinstance(d, str) else json.dumps(d) for d in documents])
    schema, conflicts = inferred_schema(variant_lines(spark, path))
    return {f.name: f.dataType.simpleString() for f in schema}, conflicts


def test_types_of_all_documents(spark, tmp_path):
    found, conflicts = schema_of(
        spark, tmp_path,
        {"a": 1, "b": "x", "c": None, "d": 1.5, "e": {"f": [1, 2.5], "g": {}}, "h": True, "l": []},
        {"a": 2, "d": 3, "e": {"f": [], "i": "y"}, "k": 1e300},
        {"d": 1e-30, "j": [{"p": 1}, {"q": "z"}], "k": 12345678901234567890},
    )
    assert found == {
        "a": "bigint", "b": "string", "c": "string", "d": "double", "h": "boolean", "k": "double", "l": "array<string>",
        "e": "struct<f:array<double>,g:string,i:string>", "j": "array<struct<p:bigint,q:string>>",
    }
    assert conflicts == []


def test_fields_of_several_types_are_text_and_named(spark, tmp_path):
    found, conflicts = schema_of(
        spark, tmp_path,
        {"a": 1, "b": {"c": 1}, "d": [1, 2.5, 1e300], "e": [1], "odd 'n\"ame": 1},
        {"a": "many", "b": {"c": "x"}, "d": [3], "e": ["x"], "odd 'n\"ame": 1.5},
        {"a": {"z": 1}},
    )
    assert found == {
        "a": "string", "b": "struct<c:string>", "d": "array<double>", "e": "array<string>", "odd 'n\"ame": "double",
    }
    assert sorted(conflicts) == ["a", "b.c", "e.[]"]
    target = str(tmp_path / "t")
    load_lines(spark, str(tmp_path / "in.json"), target)
    rows = read_loaded(spark, target).collect()
    assert sorted(r["a"] for r in rows) == ["1", "many", '{"z":1}']
    assert sorted(r["b"]["c"] for r in rows if r["b"]) == ["1", "x"]


def test_only_whole_objects_are_documents(spark, tmp_path):
    good = ['{"a":1}', "{}", '{"a":"x, ]"}', '{"a":"é \\" \\u00e9"}', ' {"a":[null]} ']
    bad = [
        "{oops", '{"a":1} x', '{"a":1},{"b":2}', '{"a":1},null', "5", '"text"', "null", "[1]", "{'a':1}",
        '{"a":01}', '{"a":1', '{"a":NaN}', "x", '{"a":1}]', '{"a":1}}',
    ]
    target = str(tmp_path / "t")
    result = load_lines(spark, write(tmp_path, good + bad), target)
    assert (result["inserted"], result["rejected"]) == (len(good), len(bad))
    assert read_loaded(spark, target).count() == len(good)
    assert sorted(r["line"] for r in read_rejected(spark, target).collect()) == sorted(bad)


def test_given_types_and_their_misfits(spark, tmp_path):
    lines = ['{"n":1,"s":"a"}', '{"n":"many","s":5}', '{"n":"7","extra":1}', '{"n":null,"t":[1]}', '{"n":2.0,"t":["x"]}', "{bad"]
    target = str(tmp_path / "t")
    result = load_lines(spark, write(tmp_path, lines), target, "n bigint, s string, t array<int>")
    assert result == {"inserted": 5, "rejected": 1, "conflicts": [], "misfits": {"n": 1, "t": 1}}
    rows = read_loaded(spark, target)
    assert rows.columns == ["n", "s", "t", "uploaded_at"]
    assert sorted((r["n"] is not None, r["n"], r["s"]) for r in rows.collect() if r["n"]) == [
        (True, 1, "a"), (True, 2, None), (True, 7, None),
    ]


def test_loads_append_and_may_bring_new_fields(spark, tmp_path):
    target = str(tmp_path / "t")
    assert load_json(spark, write(tmp_path, ['{"a":1}', "{bad"]), target, lines=True)["rejected"] == 1
    load_json(spark, write(tmp_path, ['{"a":2,"b":"x"}']), target, lines=True)
    rows = sorted((r["a"], r["b"]) for r in read_loaded(spark, target).collect())
    assert rows == [(1, None), (2, "x")]
    assert read_rejected(spark, target).count() == 1


def test_empty_files_and_files_without_documents(spark, tmp_path):
    target = str(tmp_path / "t")
    for lines in ([], ["{bad"], ["{}"]):
        result = load_lines(spark, write(tmp_path, lines), target)
        assert result["inserted"] == (lines == ["{}"]) and result["rejected"] == (lines == ["{bad"])
    assert read_loaded(spark, target).columns == ["uploaded_at"]
    with pytest.raises(ValueError, match="line"):
        load_lines(spark, write(tmp_path, ['{"line":1}']), target)


def test_one_parse_and_one_write(spark, tmp_path):
    path = write(tmp_path, ['{"a":1,"b":2}', "{bad"])
    parsed = variant_lines(spark, path)
    from purchase_signals.sources.json_variant import typed_fields

    values, _ = typed_fields(T.StructType.fromDDL("a int, b int, c string"))
    rows = parsed.select(*[v.alias(n) for n, v in values.items()])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson(") == 1 and plan.count("FileScan text") == 1


def _jobs(spark, work):
    """How many jobs ``work`` starts, and what it returns."""
    group = f"counted-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_types_that_a_first_look_shows_need_no_further_reading(spark, tmp_path, monkeypatch):
    documents = [{"a": i, "b": {"c": 1.5}} for i in range(50)] + [{"a": "x", "b": {"c": 1}}, {"a": 1e300, "b": {"c": 1e300}}]
    parsed = variant_lines(spark, write(tmp_path, [json.dumps(d) for d in [*documents[::-1], "no object"]]))
    seen = []
    plain = json_variant._is_number
    monkeypatch.setattr(json_variant, "_is_number", lambda v, p: seen.append(p) or plain(v, p))
    (found, conflicts), early = _jobs(spark, lambda: inferred_schema(parsed))
    assert len({p for p in seen if p == ("a",)}) == 1
    # The same where the look misses them, by one more reading.
    monkeypatch.setattr(json_variant, "LOOK", 0)
    (again, more), late = _jobs(spark, lambda: inferred_schema(parsed))
    assert early < late and (again, more) == (found, conflicts)
    assert found.simpleString() == "struct<a:string,b:struct<c:double>>" and conflicts == ["a"]


def test_lines_are_parsed_once_for_their_types(spark, tmp_path):
    parsed = variant_lines(spark, write(tmp_path, ['{"a":1}', "{bad"]))
    plans = []
    plain = type(parsed).agg

    def kept(self, *columns):
        result = plain(self, *columns)
        plans.append(result._jdf.queryExecution().executedPlan().toString())
        return result

    type(parsed).agg = kept
    try:
        inferred_schema(parsed)
    finally:
        type(parsed).agg = plain
    assert plans and all(p.count("parseJson(") == 1 for p in plans)


def test_other_formats_get_the_documents(spark, tmp_path):
    target = str(tmp_path / "t")
    result = load_lines(spark, write(tmp_path, ['{"a":1}', "{bad"]), target, fmt="json")
    assert spark.read.json(target).select("a").collect() == [(1,)]
    assert set(spark.read.json(target).columns) == {"a", "uploaded_at"}
    assert spark.read.parquet(result["rejected_lines"]).select("line").collect() == [("{bad",)]


@pytest.fixture
def many(tmp_path):
    lines = [json.dumps({"game": f"g{i % 3}", "comment_count": i, "own": [i]}) for i in range(3000)]
    lines += ['{"game":"same"}'] * 500 + ["{bad"] * 100
    return write(tmp_path, lines)


def test_a_sample_keeps_all_fields_and_does_not_follow_the_layout(spark, many, tmp_path):
    draws = []
    for size in ("2000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            for first in (1000, None):
                out = sample_json(spark, many, str(tmp_path / f"s{size}{first}"), first)
                got = spark.read.parquet(out)
                assert got.columns == [*REVIEW_SCHEMA.names, "own"]
                draws.append(sorted(map(str, got.collect())))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert draws[0] == draws[2] and draws[1] == draws[3] and draws[0] != draws[1]
    assert all(len(d) == 200 for d in draws)
    # Equal lines are rows of their own: about a seventh of all.
    assert 10 < sum("'same'" in r for r in draws[1]) < 60
    everything = sample_json(spark, many, str(tmp_path / "all"), None, 10_000)
    assert spark.read.parquet(everything).where("game = 'same'").count() == 500


def test_command_line(spark, many, tmp_path):
    out = str(tmp_path)
    sample = main(["sample", "--input", many, "--output", f"{out}/sample", "--all", "--rows", "9"])
    assert spark.read.parquet(sample["sample"]).count() == 9
    shown = main(["preview", "--input", many, "--rows", "2"])
    assert (shown["documents"], shown["rejected"]) == (3500, 100)
    assert [json.loads(line)["comment_count"] for line in shown["first"]] == [0, 1]
    loaded = main(["load", "--input", many, "--output", f"{out}/t", "--lines"])
    assert loaded == {"inserted": 3500, "rejected": 100}
    as_json = main(["load", "--input", many, "--output", f"{out}/j", "--lines", "--format", "json", "--option", "compression=gzip"])
    assert as_json["inserted"] == 3500 and spark.read.json(f"{out}/j").count() == 3500
    assert read_loaded(spark, f"{out}/t").agg(F.sum("comment_count")).first()[0] == sum(range(3000))
