import json

import pytest
from pyspark.sql import functions as F

from sheetwise import cli, config, registry
from sheetwise.functions import naming, text, units
from sheetwise.operators import batch, merges, model, params, rules, verify
from sheetwise.sources import files, fixtures
from sheetwise.streaming import watch


def table(rows, name="t", headers=("Parameter", "Min", "Typ", "Max", "Unit")):
    return (name, "Electrical Characteristics", list(headers), rows, 0.95, "vision")


def verified(spark, vision, rule, **options):
    pair = spark.createDataFrame([("d", vision, rule)], f"doc_id string, vision {fixtures.TABLE}, rule {fixtures.TABLE}")
    return verify.verify_tables(pair, **options).first()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("a, b, match", [("3.3", "3.3", 1), ("3.3", "3.30", 1), ("3.3", "3.33", 1), ("3.3", "3.5", 0), ("0", "0", 1), ("100", "101", 1), ("100", "102", 0), ("1.5V", "1.5", 1), ("-5", "-5.0", 1), ("1e400", "5", 0), ("Line 5", "5", 0), ("", "", 0)])
def test_numbers(spark, a, b, match):
    assert one(spark, text.numbers_match(F.lit(a), F.lit(b))) == bool(match)
    assert one(spark, text.numbers_match(F.lit(b), F.lit(a))) == bool(match)


@pytest.mark.parametrize("a, b, match", [("µA", "uA", 1), ("µA", "μA", 1), ("mA", "milliamp", 1), ("V", "volt", 1), ("kHz", "kilohertz", 1), ("°C", "C", 1), ("MHz", "mhz", 1), ("V", "A", 0), ("mV", "V", 0)])
def test_units(spark, a, b, match):
    assert one(spark, units.units_match(F.lit(a), F.lit(b))) == bool(match)


def test_unit_table():
    assert len(units.SPELLINGS) == 30 and len(units.lookup()) == 95


@pytest.mark.parametrize("raw, clean", [("  a  b ", "a b"), (None, ""), ("µA", "µA"), ("x\ny", "x y"), (" n  b", "n b")])
def test_cells(spark, raw, clean):
    assert one(spark, text.clean_cell(F.lit(raw).cast("string"))) == clean


@pytest.mark.parametrize("raw, number", [("1_000", 1000.0), ("1d", None), (" 4.2 ", 4.2), ("4.2-36", None), ("-.5e2", -50.0), ("inf", float("inf")), ("", None), ("1__0", None)])
def test_float_literals(spark, raw, number):
    assert one(spark, text.parse_float(F.lit(raw))) == number


def test_percent_rounds_half_to_even(spark):
    assert [one(spark, text.percent(F.lit(x))) for x in (0.985, 0.99, 0.125)] == ["98%", "99%", "12%"]


VIN = {"Parameter": "VIN", "Min": "4.2", "Typ": "", "Max": "36", "Unit": "V"}


def test_scenarios(spark):
    r = verified(spark, table([VIN]), table([VIN]))
    assert (r["status"], r["confidence"], r["resolution_method"], r["conflicts"]) == ("verified", 1.0, "perfect_match", [])
    iq = {"Parameter": "IQ", "Min": "", "Typ": "25", "Max": "", "Unit": "µA"}
    assert verified(spark, table([iq]), table([iq | {"Unit": "uA"}]))["resolution_method"] == "perfect_match"
    r = verified(spark, table([VIN | {"Parameter": "VIN_MAX"}]), table([VIN | {"Parameter": "VIN_MAX", "Max": "35"}]))
    assert (r["status"], r["confidence"], r["conflicts"][0]["severity"], r["conflicts"][0]["resolution"]) == ("verified", 0.9, "critical", "vision_wins")
    r = verified(spark, table([VIN]), table([VIN | {"Max": "24"}]))
    assert (r["status"], r["resolution_method"], r["confidence"]) == ("needs_review", "manual_required", 0.9)
    r = verified(spark, table([VIN]), table([VIN | {"Max": ""}]))
    assert (r["status"], r["confidence"]) == ("verified", 0.9)
    r = verified(spark, table([VIN]), None)
    assert (r["status"], r["confidence"], r["resolution_method"]) == ("verified", 0.85, "vision_only")
    gain = {"Parameter": "Gain", "Typ": "1", "Unit": "V"}
    r = verified(spark, table([gain, gain]), table([gain | {"Unit": ""}]))
    assert [c["conflict_type"] for c in r["conflicts"]] == ["unit"] and r["conflicts"][0]["resolution"] == "rule_wins"
    assert [x["Unit"] for x in r["merged_rows"]] == ["", "V"]
    assert verified(spark, table([gain]), table([gain | {"Unit": ""}]), arbiter="vision")["merged_rows"][0]["Unit"] == "V"
    r = verified(spark, table([gain]), table([gain | {"Extra": "x"}]))
    assert r["conflicts"][0]["field"] == "row[0].Extra" and r["merged_rows"][0]["Extra"] == ""
    r = verified(spark, table([]), table([gain], headers=["Parameter"]))
    assert [c["field"] for c in r["conflicts"]] == ["headers"] and r["conflicts"][0]["severity"] == "medium"


@pytest.mark.parametrize("n, level, want", [(40, "low", 0.5999999999999996), (16, "medium", 0.5999999999999996), (8, "high", 0.5999999999999996), (4, "critical", 0.6000000000000001)])
def test_confidence_is_folded_in_order(spark, n, level, want):
    levels = F.array(*[F.lit(level)] * n)
    assert one(spark, verify.fold_confidence(F.transform(levels, verify.penalty))) == want


def test_demo_pair(spark):
    done = verify.verify_tables(fixtures.demo_pair(spark))
    r = done.first()
    assert (r["status"], r["confidence"], r["resolution_method"], [c["field"] for c in r["conflicts"]]) == ("verified", 0.99, "auto_resolved", ["table_id"])
    numbers = params.long_parameters(done)
    assert numbers.count() + numbers.select("base").distinct().count() == 14
    docs = params.parameter_maps(numbers).withColumns({"source_file": F.lit("/x/lmr51430.pdf"), "mpn": F.lit(None).cast("string"), "manufacturer": F.lit(""), "confidence": F.lit(0.99)})
    row = params.importer_rows(docs).first().asDict()
    assert list(row.values()) == ["LMR51430", "", "Buck Converter", "", "4.2", "36.0", "", "", "3.0", "25.0", "92.0", "400.0", "", "Active", "", "Extracted by sheetwise (confidence: 99%)"]
    about = done.select("doc_id", F.lit("/x/lmr51430.pdf").alias("source_file"), F.col("vision.confidence").alias("table_confidence"), "confidence", F.lit("double_verified_vision").alias("method"), F.array(F.lit("vision_table_1")).alias("table_ids"))
    record = params.review_records(about.join(params.listed_parameters(numbers), "doc_id", "left")).first()
    assert record["manufacturer"] == "Texas Instruments" and set(record["params"]) == {"v_in_min", "v_in_max", "i_q", "i_q_max", "i_out_max", "fsw_min", "fsw", "fsw_max", "efficiency"}
    assert record["params"]["i_q"].asDict() == {"value": 25.0, "unit": "µA", "confidence": 0.95, "source": "page_1_vision_table_1", "verified_by": ["vision", "pdfplumber"], "needs_review": False}
    out = params.documents_out(done, raw=True).first()
    assert out["verification"]["conflict_count"] == 1 and len(out["parameters"]) == 9 and out["raw"]["rule"]["rows"][1]["Unit"] == "uA"
    wide = params.wide_parameters(numbers).first().asDict()
    assert list(wide)[1:] == sorted(list(wide)[1:]) and wide["efficiency_typ"] == 92.0
    assert params.failed_parameters(done).count() == 0 and fixtures.prototype_graph(spark).count() == 3


def grid_frame(spark, *grids):
    return spark.createDataFrame([("d", 1, i, "Electrical   Characteristics of LMR51430", g) for i, g in enumerate(grids)], "doc_id string, page_num int, table_idx int, text string, grid array<array<string>>")


def test_rule_tables(spark):
    grid = [["Parameter", "Test Conditions", "Min", "Typ", "Max", "Unit"], ["VIN", "x", "4.2", None, "36", "V", "more"], [None, "", None, "", "", ""], [" ", "", "", "", "", ""]]
    r = rules.tables_from_grids(grid_frame(spark, [["one row"]], grid)).first()
    assert (r["table_id"], r["title"], r["confidence"]) == ("table_p1_1", "Electrical   Characteristics", 0.9)
    assert r["headers"][1] == "Test_Conditions" and len(r["rows"]) == 2 and r["rows"][0]["col_6"] == "more" and r["rows"][0]["Typ"] == ""
    double = rules.tables_from_grids(grid_frame(spark, [["Min", "min", "x"], ["1", "2", "3"]])).first()
    assert double["rows"][0]["Min"] == "2" and double["confidence"] == 0.6


def test_merged_cells(spark):
    grid = [["", "Output Voltage", "", "", ""], ["Parameter", "Min", "Typ", "Max", "Unit"], ["VOUT Accuracy", "-1", "", "+1", "%"], ["Load Regulation", "", "0.1", "0.5", "%"]]
    found = merges.detect_merges(grid_frame(spark, grid, [["x"]]))
    r, short = found.orderBy("table_idx").collect()
    assert [(m["row"], m["col_start"], m["col_end"], m["confidence"]) for m in r["merges"]] == [(0, 1, 4, 0.85), (3, 0, 1, 0.7)]
    assert r["merge_confidence"] == pytest.approx(0.775) and not r["needs_vision"] and short["merges"] == [] and short["merge_confidence"] == 1.0
    solved = merges.resolve_merges(found).orderBy("table_idx").first()
    assert solved["resolved_headers"] == ["", *["Output Voltage"] * 4]
    assert solved["resolved_rows"] == [{"": "Parameter", "Output Voltage": "Unit"}, {"": "VOUT Accuracy", "Output Voltage": "%"}, {"": "Load Regulation", "Output Voltage": "%"}]


def test_width_merges(spark):
    wide = lambda *w: [(0.0, float(x)) for x in w]
    data = [("d", [["a", "b"], ["c", ""], ["e", "f"]], [wide(10, 10), wide(25, 10), wide(10, 12)])]
    frame = spark.createDataFrame(data, "doc_id string, grid array<array<string>>, pos array<array<struct<x0: double, x1: double>>>")
    r = merges.detect_merges(frame, "pos").first()
    assert [(m["row"], m["col_start"], m["col_end"], m["content"]) for m in r["merges"] if m["confidence"] == 0.9] == [(1, 0, 1, "c")]


def test_names(spark):
    assert one(spark, naming.part_in_text(F.lit("an LM5 and TPS54A"))) == "TPS54A"
    assert one(spark, naming.maker_of_part(F.lit("mcp73831"))) == "Microchip"
    assert one(spark, naming.diagram_type(F.lit("Typical  Application"))) == "typical_app"
    assert one(spark, naming.review_part(F.lit(""))) == "UNKNOWN"
    assert one(spark, text.page_file(F.lit(7))) == "page_007.png"


def test_model_boundary(spark):
    requests = spark.createDataFrame([("1", "read the TABLE", b"x"), ("2", "draw the pinout diagram", None), ("3", "fail please", None)], "request_id string, prompt string, image binary")

    def make():
        def client(prompt, image):
            if "fail" in prompt:
                raise TimeoutError("no answer")
            return model.MockClient()(prompt, image)

        return client

    got = {r["request_id"]: r for r in model.ask_model(requests, make, attempts=2, wait=lambda n: 0.0).collect()}
    assert got["1"]["success"] and not got["3"]["success"] and got["3"]["attempts"] == 2 and "no answer" in got["3"]["error"]
    assert one(spark, model.json_answer(F.lit(got["1"]["content"]), model.TABLE_SCHEMA))["columns"][0] == "Parameter"
    assert one(spark, model.json_answer(F.lit("no json"), model.TABLE_SCHEMA)) is None
    assert model.spend(model.ask_model(requests, make, 1)).first()[0] == 0.0
    asked = model.requests_for(spark.createDataFrame([("1", b"x")], "request_id string, image binary"), "block_diagram")
    assert len(model.read_answers(model.ask_model(asked, make), "block_diagram").first()["read"]["edges"]) == 2


def parse(content: bytes):
    if content == b"bad":
        yield {"text": "first"}
        raise ValueError("broken")
    yield {"text": "Electrical Characteristics", "tables": [[["Parameter", "Min", "Max", "Unit"], ["Input Voltage Range", "4.2", content.decode(), "V"]]], "width": 612.0, "height": 792.0}


def test_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "lmr1.pdf").write_bytes(b"36")
    (source / "bad.pdf").write_bytes(b"bad")
    first = cli.run_batch(spark, str(source), out, parse, csv=True).first()
    assert (first["total"], first["success"], first["failed"], first["skipped"]) == (2, 1, 1, 0)
    (source / "tps2.pdf").write_bytes(b"40")
    second = cli.run_batch(spark, str(source), out, parse).first()
    assert (second["success"], second["skipped"]) == (1, 2)
    assert any("| Success Rate | 100.0% |" in r["value"] for r in spark.read.text(f"{out}/report").collect())
    assert spark.read.option("header", True).csv(f"{out}/for_import_script").first()["MPN"] == "LMR1"


def test_stream_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.pdf").write_bytes(b"1")
    seen = []
    for more in ("b", "c"):
        query = watch.run_batches(watch.watch_files(spark, str(source)), lambda df, n: seen.extend(r["path"][-5:] for r in df.collect()), str(tmp_path / "state"))
        query.awaitTermination()
        (source / f"{more}.pdf").write_bytes(b"2")
    assert seen == ["a.pdf", "b.pdf"]


def test_sources(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"metadata": {"mpn": "X"}, "verification": {"status": "verified", "confidence": 0.9}, "parameters": {"a_min": "1"}}))
    assert files.read_results(spark, str(tmp_path / "r.json")).first()["metadata"]["mpn"] == "X"
    pages = spark.createDataFrame([("d", 1, [[["a"]], [["a"], ["b"]]])], "doc_id string, page_num int, tables array<array<array<string>>>")
    assert files.table_regions(pages).first()["bbox"].asDict() == {"x0": 50.0, "y0": 300.0, "x1": 550.0, "y1": 500.0}
    images = files.render_pages(spark.createDataFrame([("p", b"x")], "path string, content binary"), lambda c, n, dpi: (c * n, 1, 1) if n < 3 else None, first=1, last=4)
    assert sorted(bytes(r["image"]) for r in images.collect()) == [b"x", b"xx"]


def test_summary_and_best(spark):
    cells = spark.createDataFrame([(1, 0, True), (1, 0, False), (1, 1, True), (2, 0, True)], "doc_id int, row_idx int, matched boolean")
    assert tuple(batch.accuracy(cells).first()) == (0.75, pytest.approx(2 / 3), 0.5)
    kept = params.best_per_key(spark.createDataFrame([("k", 0.5, 1), ("k", 0.9, 3), ("k", 0.9, 2)], "k string, c double, o int"), ["k"], "c", "o")
    assert kept.first()["o"] == 2


def test_all_pages_are_rendered(spark):
    data = spark.createDataFrame([("p", b"xxx"), ("q", b"x"), ("none", b"")], "path string, content binary")
    images = files.render_pages(data, lambda c, n, dpi: (c[:n], 1, 1) if n != 2 else None, count=len)
    assert sorted((r["doc_id"], r["page_num"]) for r in images.collect()) == [("p", 1), ("p", 3), ("q", 1)]
    with pytest.raises(ValueError, match="counts pages"):
        files.render_pages(data, lambda c, n, dpi: None)


def test_verify_prints_all_documents(spark, tmp_path, capsys):
    spark.range(1200).selectExpr("concat('d', id) AS doc_id", "'verified' AS status", "0.9D AS confidence", "'none' AS resolution_method", "array('c') AS conflicts", "struct(1 AS table_id) AS vision").write.parquet(str(tmp_path / "results"))
    assert cli.main(["verify", str(tmp_path)]) == 0
    lines = capsys.readouterr().out.splitlines()
    assert sum(x.startswith("d") and "\tverified\t0.9\tnone\t1" in x for x in lines) == 1200


def test_two_readers_are_verified(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "tps1.pdf").write_bytes(b"36")

    def other(content):
        yield {"text": "Electrical Characteristics", "tables": [[["Parameter", "Min", "Max", "Unit"], ["Input Voltage Range", "4.2", "24", "V"]], [["Parameter", "Typ", "Unit"], ["Quiescent Current", "25", "uA"]]], "width": 1.0, "height": 1.0}

    cli.run_batch(spark, str(source), out, parse, second=other, csv=True)
    rows = {r["table_idx"]: r for r in spark.read.parquet(f"{out}/results").collect()}
    assert rows[0]["resolution_method"] == "auto_resolved" and rows[0]["conflicts"][0]["field"] == "row[0].Max" and rows[1]["resolution_method"] == "vision_only"
    line = spark.read.option("header", True).csv(f"{out}/for_import_script").first()
    assert (line["Vin_max"], line["Iq_typ"], line["Category"]) == ("24.0", "25.0", "LDO")
    cli.scan(spark, str(source), str(tmp_path / "scan"), parse)
    assert spark.read.option("multiLine", True).json(str(tmp_path / "scan" / "documents")).first()["tables"][0]["table_id"] == "table_p1_0"
    for kind in ("wide", "documents", "review"):
        assert cli.main(["export", out, str(tmp_path / kind), "--format", kind]) == 0
    wide = spark.read.option("header", True).csv(str(tmp_path / "wide")).first().asDict()
    assert list(wide)[1:] == ["confidence", "status", "input_voltage_range_max", "input_voltage_range_min", "quiescent_current_typ"] and wide["quiescent_current_typ"] == "25.0"
    assert spark.read.option("multiLine", True).json(str(tmp_path / "documents")).count() == 2
    assert spark.read.json(str(tmp_path / "review")).first()["params"]["i_q"]["value"] == 25.0


def test_documents_are_written_one_by_one(spark, tmp_path):
    docs = spark.createDataFrame([("/a/x.pdf", "verified"), ("/a/y.pdf", "conflict")], "doc_id string, status string")
    files.write_documents(docs, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["name=x", "name=y"]
    assert {(r["name"], r["status"]) for r in spark.read.option("multiLine", True).json(str(tmp_path / "out")).collect()} == {("x", "verified"), ("y", "conflict")}


def test_files_are_tried_again(spark, tmp_path):
    mark = tmp_path / "tries"

    def flaky(content):
        with mark.open("a") as f:
            f.write("x")
        yield {"text": "a"}
        if content == b"bad" or len(mark.read_text()) < 3:
            raise OSError("gone")

    data = spark.createDataFrame([("p", b"good")], "path string, content binary")
    assert [(r["page_num"], r["error"]) for r in files.read_pages(data, flaky).collect()] == [(1, None)] and mark.read_text() == "xxx"
    mark.unlink()
    bad = spark.createDataFrame([("p", b"bad")], "path string, content binary")
    assert [(r["page_num"], r["error"]) for r in files.read_pages(bad, flaky).collect()] == [(1, None), (2, "OSError: gone")] and mark.read_text() == "xxx"


def test_budget_over_waves(spark, tmp_path):
    class Dear(model.MockClient):
        def __call__(self, prompt, image):
            return super().__call__(prompt, image) | {"cost_usd": 0.6}

    def keep(answers, n):
        answers.write.parquet(str(tmp_path / str(n)))
        return spark.read.parquet(str(tmp_path / str(n)))

    wave = lambda *ids: spark.createDataFrame([(i, "table", None) for i in ids], "request_id string, prompt string, image binary")
    got = {r["request_id"]: (r["success"], r["error"]) for r in model.ask_in_waves([wave("a"), wave("b"), wave("c", "d")], Dear, 1.0, keep).collect()}
    over = (False, "Budget exceeded: $1.20 >= $1.00")
    assert got == {"a": (True, None), "b": (True, None), "c": over, "d": over}


def test_http_client():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            shown = asked["messages"][0]["content"]
            body = json.dumps({"choices": [{"message": {"content": shown[0]["text"] + "/" + shown[1]["image_url"]["url"]}}], "usage": {"prompt_tokens": 1000, "completion_tokens": 2000}}).encode()
            self.send_response(200 if self.headers["Authorization"] == "Bearer k" else 401)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/v1"
    got = model.HttpClient(url, "k", "gpt-4o")("table", "aW1n")
    assert got["content"] == "table/data:image/png;base64,aW1n" and got["cost_usd"] == pytest.approx(0.035)
    with pytest.raises(OSError):
        model.HttpClient(url, "wrong")("table", "")
    server.shutdown()


def test_settings(tmp_path):
    assert config.Settings.from_dict({"include_raw": True, "unheard": 1}).include_raw
    own = config.Settings(critical_params=["Vin", "I: q"], vision_model="it's", budget_per_datasheet=1.5)
    own.to_yaml(str(tmp_path / "c.yaml"))
    assert config.Settings.from_yaml(str(tmp_path / "c.yaml")) == own
    (tmp_path / "d.yaml").write_text("# own\nvision_model: gpt-4o # big\nverification_enabled: false\ncritical_params:\n  - Vin\n  - 'Iq'\n")
    read = config.Settings.from_yaml(str(tmp_path / "d.yaml"))
    assert (read.vision_model, read.verification_enabled, read.critical_params) == ("gpt-4o", False, ["Vin", "Iq"])
    with pytest.raises(TypeError):
        config.Settings(**config.parse_yaml("unheard: 1"))


def test_registry(spark):
    registry.ARBITERS.register("none", lambda kind, vision, rule: F.lit("vision_wins"))
    assert "none" in registry.KINDS["arbiter"].list_types() and verify.ARBITERS["none"]
    registry.ARBITERS.parts.pop("none")
    with pytest.raises(ValueError, match="no client named"):
        registry.CLIENTS.create("unheard")


# fixed values, as a second copy of the tables that the engine looks up
GOLDEN_UNITS = {"ua": "µA", "μa": "µA", "micro-amp": "µA", "ma": "mA", "amps": "A", "uv": "µV", "millivolt": "mV", "volt": "V", "kv": "kV", "microwatt": "µW", "mw": "mW", "watts": "W", "kw": "kW", "uf": "µF", "nf": "nF", "pf": "pF", "uh": "µH", "mh": "mH", "nh": "nH", "r": "Ω", "k-ohm": "kΩ", "mr": "MΩ", "hertz": "Hz", "khz": "kHz", "mhz": "MHz", "ghz": "GHz", "deg c": "°C", "f": "°F", "nanosec": "ns", "us": "µs", "millisec": "ms", "sec": "s"}
GOLDEN_MAKERS = {"LM317": "Texas Instruments", "TPS1": "Texas Instruments", "MAX1": "Analog Devices", "AD8": "Analog Devices", "LT1": "Analog Devices", "LTC1": "Analog Devices", "MCP1": "Microchip", "PIC1": "Microchip", "STM32": "STMicroelectronics", "NCP1": "onsemi", "MC78": "onsemi", "ISL1": "Renesas", "IR21": "Infineon", "INA1": "Texas Instruments", "OPA2": "Texas Instruments", "XYZ": ""}
GOLDEN_NAMES = {"input_voltage_range_min": "v_in_min", "input_voltage_range_max": "v_in_max", "output_voltage_min": "v_out_min", "output_voltage_max": "v_out_max", "output_current_max": "i_out_max", "quiescent_current_typ": "i_q", "quiescent_current_max": "i_q_max", "switching_frequency_typ": "fsw", "switching_frequency_min": "fsw_min", "switching_frequency_max": "fsw_max", "efficiency_typ": "efficiency", "other": "other"}
GOLDEN_HEADERS = {"Param.": "Parameter", "SYMBOL": "Symbol", "Test Conditions": "Test_Conditions", "Conditions": "Test_Conditions", "MIN.": "Min", "Typical": "Typ", "max value": "Max", "Units": "Unit", "Description": "Description", "": "Unknown", "Note": "Note", "a min": "a min"}
GOLDEN_TITLES = {"see ELECTRICAL characteristics": "Electrical Characteristics", "Absolute Maximum Ratings": "Absolute Maximum Ratings", "recommended operating conditions": "Recommended Operating Conditions", "thermal information": "Thermal Information", "pin functions": "Pin Functions", "device comparison": "Device Comparison", "none": "Table 1"}
GOLDEN_DIAGRAMS = {"block diagram": "block_diagram", "Functional Diagram": "block_diagram", "typical application": "typical_app", "application circuit": "typical_app", "Pin Configuration": "pinout", "package": "pinout", "none": None}
GOLDEN_CATEGORIES = {"Input range": True, "x characteristics": True, "absolute 1 2 3 4 5 6": True, "12 conditions": True, "dc 12345": True, "ac/12345": False, "abcde1": True, "abcd12": False, "": False}


@pytest.mark.parametrize(
    ("table", "function"),
    [
        (GOLDEN_UNITS, lambda c: units.normal_unit(c)), (GOLDEN_MAKERS, lambda c: naming.maker_of_part(c)), (GOLDEN_NAMES, lambda c: naming.review_name(c)), (GOLDEN_HEADERS, lambda c: rules.normal_header(c)),
        (GOLDEN_TITLES, lambda c: naming.table_title(c, F.lit(0))), (GOLDEN_DIAGRAMS, lambda c: naming.diagram_type(c)), (GOLDEN_CATEGORIES, lambda c: merges.is_category(c)),
    ],
)
def test_golden_tables(spark, table, function):
    got = spark.createDataFrame([(k,) for k in table], "k string").select("k", function(F.col("k")).alias("v")).collect()
    assert {r["k"]: r["v"] for r in got} == table


class Run:
    """Stands for files or images, and runs what would be mapped over them."""

    def __init__(self, **columns):
        self.columns = columns

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        import pyarrow as pa

        return list(run(iter([pa.RecordBatch.from_pydict(self.columns)])))


def test_pages_are_handed_back_in_batches():
    found = files.read_pages(Run(path=[f"f{i}" for i in range(3000)], content=[b"x"] * 3000), lambda content: [{"text": "a", "tables": [[["b", None]]], "width": 1}])
    assert [b.num_rows for b in found] == [1000, 1000, 1000] and found[2].to_pylist()[-1] == {"doc_id": "f2999", "page_num": 1, "text": "a", "tables": [[["b", None]]], "width": 1.0, "height": None, "error": None}


def test_images_are_handed_back_in_batches():
    made = lambda size: files.render_pages(Run(path=[f"f{i}" for i in range(1500)], content=[b"x"] * 1500), lambda content, n, dpi: (content * size, 2, 3), last=1)
    assert [b.num_rows for b in made(1)] == [1000, 500] and made(1)[0].to_pylist()[0] == {"doc_id": "f0", "page_num": 1, "image": b"x", "width": 2, "height": 3, "dpi": 150}
    assert [b.num_rows for b in made(files.BYTES // 500)] == [501, 501, 498]
