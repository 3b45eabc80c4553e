import hashlib
import struct
import unicodedata
import uuid

import pytest
from pyspark.sql import functions as F

from meshwright import adapters, cli
from meshwright.functions import identity
from meshwright.operators import audit, runs
from meshwright.operators.landmarks import NAMES
from meshwright.sources import assets, inputs, obj, runmeta
from shapes import TETRAHEDRON, mesh_set

GOOD = """# comment
mtllib a.mtl
o thing
v 0 0 0 1.0
v 1 0 0   # inline
v 0 1 0
vt 0 0
vn 0 0 1
usemtl red
s off
weird 1 2
f 1/1/1 2/1/1 -1/1/1
"""


def write(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.obj").write_text(text)
    return str(folder)


def test_obj_text_is_parsed_with_its_inventory(spark, tmp_path):
    parsed = obj.read_obj(spark, write(tmp_path / "m", good=GOOD))
    row = parsed.files.first()
    assert row["error"] is None
    assert (row["texture_vertices"], row["vertex_normals"], row["material_directives"],
            row["object_group_directives"], row["smoothing_directives"]) == (1, 1, 2, 1, 1)
    assert [(r["directive"], r["n"]) for r in parsed.unknown.collect()] == [("weird", 1)]
    face = parsed.meshes.faces.first()
    assert (face["a"], face["b"], face["c"]) == (0, 1, 2)
    assert [r["x"] for r in parsed.meshes.vertices.orderBy("vid").collect()] == [0.0, 1.0, 0.0]


@pytest.mark.parametrize("text, message", [
    ("v 0 0 0\nv 1 0 0\nv 1 1 0\nv 0 1 0\nf 1 2 3 4\n", "three vertices at line 5"),
    ("v nan 0 0\nv 1 0 0\nv 0 1 0\nf 1 2 3\n", "not finite at line 1"),
    ("v 1e999 0 0\nf 1 1 1\n", "not finite at line 1"),
    ("v 0 0 0\nv 1 0 0\nv 0 1 0\nf 1 2 4\n", "out of range at line 4"),
    ("v 0 0 0\nf 1 2 1\nv 1 0 0\n", "out of range at line 2"),
    ("v 0 0 0\nf 0 1 1\n", "index zero at line 2"), ("v 0 0 0\nf /1 1 1\n", "missing vertex index at line 2"),
    ("v 0 0 0\nf a 1 1\n", "not an integer at line 2"), ("v 0 x 0\nf 1 1 1\n", "not a number at line 1"),
    ("v 0 0\nf 1 1 1\n", "three coordinates at line 1"), ("v 0 0 0\n", "no triangular face"), ("f 1 1 1\n", "out of range"),
    ("# only a comment\n", "no vertex"), ("", "no vertex"),
])
def test_defects_are_reported_per_file(spark, tmp_path, text, message):
    records, parsed = inputs.discover(spark, write(tmp_path / "m", bad=text, good=GOOD))
    rows = {r["output_key"]: r for r in records.collect()}
    assert message in rows["bad"]["input_error"]
    assert rows["good"]["input_error"] is None
    expected = hashlib.sha256(f"invalid-geometry:{hashlib.sha256(text.encode()).hexdigest()}".encode()).hexdigest()
    assert rows["bad"]["geometry_sha256"] == expected
    assert parsed.meshes.vertices.count() == 3


def test_large_files_are_parsed_across_splits(spark, tmp_path):
    count = 4000
    lines = [f"v {n} {n * 0.5} 0" for n in range(count)] + ["", "# tail"]
    lines += [f"f {n + 1} {n + 2} -1" for n in range(count - 2)]
    folder = write(tmp_path / "m", big="\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8KB")
    try:
        assert obj.read_lines(spark, folder).select("block").distinct().count() > 5
        parsed = obj.read_obj(spark, folder)
        vertices = parsed.meshes.vertices.agg(
            F.count(F.lit(1)), F.count_if(F.col("x") == F.col("vid")), F.max("vid")).first()
        faces = parsed.meshes.faces.agg(
            F.count(F.lit(1)), F.count_if((F.col("a") == F.col("fid")) & (F.col("c") == count - 1))).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(vertices) == (count, count, count - 1)
    assert tuple(faces) == (count - 2, count - 2)


def test_canonical_text(spark, tmp_path):
    points = [(-0.0, 1.00000000005, 2), (1, 0, 0), (0, 1 / 3, 0)]
    meshes = mesh_set(spark, {"m": (points, [(0, 1, 2)])})
    obj.write_obj(meshes, str(tmp_path / "out"))
    text = [r[0] for r in spark.read.text(str(tmp_path / "out" / "mesh_id=m")).collect()]
    assert text == [f"v {x:.10f} {y:.10f} {z:.10f}" for x, y, z in points] + ["f 1 2 3"]
    assert text[0].startswith("v -0.0000000000 ")
    bad = mesh_set(spark, {"m": ([(float("nan"), 0, 0)] * 3, [(0, 1, 2)])})
    with pytest.raises(ValueError, match="non-finite"):
        obj.write_obj(bad, str(tmp_path / "bad"))


def _digest(points, faces):
    digest = hashlib.sha256(identity.GEOMETRY_TAG)
    digest.update(struct.pack("<QQ", len(points), 3))
    for p in points:
        digest.update(struct.pack("<3d", *[float(v) + 0.0 for v in p]))
    digest.update(struct.pack("<QQ", len(faces), 3))
    for f in faces:
        digest.update(struct.pack("<3q", *f))
    return digest.hexdigest()


def test_geometry_hash_streams_batches(spark):
    many = [(n * 0.5, -0.0, n % 7) for n in range(300)]
    sides = [(n, n + 1, n + 2) for n in range(298)]
    meshes = mesh_set(spark, {1: TETRAHEDRON, 2: (many, sides)})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = {r[0]: r[1] for r in identity.geometry_hashes(meshes.vertices, meshes.faces).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {1: _digest(*TETRAHEDRON), 2: _digest(many, sides)}


def test_keys_seeds_and_folding(spark):
    rows = [("A", "A.obj", "1"), ("a", "a.obj", "2"), ("Stra\u00dfe", "s.obj", "3"), ("STRASSE", "t.obj", "4"),
            ("e\u0301", "e.obj", "5"), ('x<>:"/|y__z', "x.obj", "6"), (" ._", "d.obj", "7")]
    table = spark.createDataFrame(rows, "stem string, relative_path string, geometry_sha256 string")
    got = {r["geometry_sha256"]: r["output_key"] for r in identity.assign_output_keys(table).collect()}
    space = uuid.UUID(identity.KEY_NAMESPACE)
    assert got["1"] == f"A__{uuid.uuid5(space, 'A.obj|1')}"
    assert got["2"] == f"a__{uuid.uuid5(space, 'a.obj|2')}"
    assert got["3"].startswith("Stra\u00dfe__") and got["4"].startswith("STRASSE__")
    assert got["5"] == unicodedata.normalize("NFC", "e\u0301")
    assert (got["6"], got["7"]) == ("x_y_z", "sample")
    seed = spark.range(1).select(identity.stage_seed(F.lit("abc"), "crop", 42)).first()[0]
    want = int.from_bytes(hashlib.sha256(b"abc:crop:42").digest()[:8], "little")
    assert int(seed) == want


def test_duplicates_are_kept_and_counted(spark, tmp_path):
    folder = write(tmp_path / "m", one=GOOD, two=GOOD + "\n# differs\n", three=GOOD.replace("v 1 0 0", "v 2 0 0"))
    (tmp_path / "m" / "four.OBJ").write_text(GOOD)
    (tmp_path / "m" / "note.txt").write_text("x")
    records, _ = inputs.discover(spark, folder)
    sizes = {r["output_key"]: r["duplicate_geometry_group_size"] for r in records.collect()}
    assert sizes == {"one": 3, "two": 3, "four": 3, "three": 1}


def test_manifest(spark, tmp_path):
    write(tmp_path / "m", one=GOOD, two=GOOD)
    manifest = tmp_path / "list.csv"
    manifest.write_text("\ufeffinput_obj,sample_id,batch_id,site\nm/one.obj,S1,,north\nm/gone.obj,,b2,\n", encoding="utf-8")
    records, _ = inputs.discover(spark, input_manifest=str(manifest))
    rows = {r["sample_id"]: r for r in records.collect()}
    assert set(rows) == {"S1", "gone"}
    assert rows["S1"]["user_metadata"] == {"site": "north"} and rows["S1"]["batch_id"] is None
    assert "gone.obj" in rows["gone"]["input_error"] and rows["gone"]["batch_id"] == "b2"
    manifest.write_text("input_obj\nm/one.obj\n./m/ONE.obj\n")
    with pytest.raises(inputs.InputError, match="duplicate"):
        inputs.discover(spark, input_manifest=str(manifest))
    manifest.write_text("path\nm/one.obj\n")
    with pytest.raises(inputs.InputError, match="input_obj"):
        inputs.discover(spark, input_manifest=str(manifest))
    with pytest.raises(inputs.InputError, match="exactly one"):
        inputs.discover(spark)
    (tmp_path / "empty").mkdir()
    with pytest.raises(inputs.InputError, match="no OBJ files"):
        inputs.discover(spark, str(tmp_path / "empty"))


def test_a_manifest_reads_only_the_files_it_names(spark, tmp_path):
    write(tmp_path / "m", **{f"f{k}": GOOD for k in range(300)})
    (tmp_path / "m" / "odd [1]{x}.obj").write_text(GOOD)
    (tmp_path / "m" / "empty.obj").write_text("")
    manifest = tmp_path / "list.csv"
    manifest.write_text("input_obj\n" + "".join(f"m/f{k}.obj\n" for k in range(9)) + "m/odd [1]{x}.obj\nm/empty.obj\nm/gone.obj\n")
    listed = inputs.listed_manifest(spark, str(manifest))
    sources = inputs._named_sources(spark, listed)
    assert len(sources) == 11
    assert inputs._files(spark, sources).select("_metadata.file_name").distinct().count() == 10  # an empty file gives no row
    records, parsed = inputs.discover(spark, input_manifest=str(manifest))
    rows = {r["relative_path"]: r["input_error"] for r in records.collect()}
    assert len(rows) == 12 and rows["m/odd [1]{x}.obj"] is None and "no vertex" in rows["m/empty.obj"] and "gone" in rows["m/gone.obj"]
    assert parsed.meshes.meshes().count() == 10
    folders = inputs._named_sources(spark, listed, most=5)
    assert [f.rsplit("/", 1)[-1] for f in folders] == ["m"]


def test_small_assets(spark, tmp_path):
    marks = tmp_path / "marks.csv"
    marks.write_text("name,x,y,z\n" + "".join(f"{n},1,2,{i}\n" for i, n in enumerate(NAMES)))
    assert assets.template_landmarks(spark, marks).count() == 9
    marks.write_text("name,x,y,z\n" + "".join(f"{n},1,2,3\n" for n in reversed(NAMES)))
    with pytest.raises(ValueError, match="canonical order"):
        assets.template_landmarks(spark, marks)
    (tmp_path / "w.csv").write_text("3.0,.2,.3,.5\n\n1,0,0,1\n")
    (tmp_path / "n.pp").write_text('<PickedPoints><point name="a"/><point name=" "/><point name="b"/></PickedPoints>')
    table = assets.projection_table(spark, tmp_path / "w.csv", tmp_path / "n.pp").orderBy("idx").collect()
    assert [(r["name"], r["fid"], r["l3"]) for r in table] == [("a", 3, 0.5), ("b", 1, 1.0)]
    (tmp_path / "r.txt").write_text("2 1 3")
    assert [tuple(r) for r in assets.mirror_table(spark, tmp_path / "r.txt", 3).collect()] == [(0, 1), (1, 0), (2, 2)]
    (tmp_path / "p.txt").write_text("0 1 2\n3.5 4 5\n")
    assert [r["x"] for r in assets.template_points(spark, tmp_path / "p.txt").orderBy("vid").collect()] == [0.0, 3.5]


def test_landmark_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("m", 1, "b&c", 1 / 3, 2.0, -0.5), ("m", 0, "a", 1e-9, 1234567.0, 0.0)],
                                 "mesh_id string, idx int, name string, x double, y double, z double")
    runmeta.write_landmark_csv(rows, str(tmp_path / "csv"))
    part = next((tmp_path / "csv" / "mesh_id=m").glob("*.csv"))
    assert part.read_text() == "name,x,y,z\na,1e-09,1234567,0\nb&c,0.333333333333,2,-0.5\n"
    text = runmeta.picked_points(rows).first()["document"]
    assert '<point name="b&amp;c" x="0.333333333333" y="2" z="-0.5" active="1" />' in text
    runmeta.write_csv(rows.select("z", "name").limit(0), str(tmp_path / "none"))
    assert all(p.stat().st_size == 0 for p in (tmp_path / "none").glob("*.csv"))


def test_text_audit(spark):
    rows = spark.createDataFrame([
        (1, "mail a.b@example.com or c@d.org"), (2, "call 13812345678 now"), (3, "a13812345678b"),
        (4, "/home/user/x and /home/alice/x"), (5, "password: hunter2"), (6, r"D:\data\x and C:\path\to\x"),
        (7, "nothing")], "doc_id int, text string")
    got = sorted((r["doc_id"], r["rule"], r["detail"]) for r in audit.findings(rows, "doc_id").collect())
    assert got == [
        (1, "email_address", "a.b@example.com"), (1, "email_address", "c@d.org"), (2, "phone_number", "13812345678"),
        (4, "unix_home_path", "/home/alice"), (5, "credential_value", "password: hunter2"),
        (6, "windows_absolute_path", r"D:\data\x")]


def test_tied_attempts_leave_one_row_per_sample(spark):
    m = {"k": "v"}
    rows = [("a", 1, 1, "staged", None, m), ("a", 2, 1, "complete", 1, m), ("a", 2, 1, "staged", 2, None), ("a", 2, 1, "staged", 2, m),
            ("a", 2, 1, "staged", 2, m), ("b", 1, 3, "complete", None, m)]
    frame = spark.createDataFrame(rows, "output_key string, committed_at int, attempt_id int, commit_state string, `odd name` int, m map<string,string>")
    got = runs.current_attempts(frame)
    assert got.columns == frame.columns
    assert sorted(map(tuple, got.collect())) == [("a", 2, 1, "staged", 2, m), ("b", 1, 3, "complete", None, m)]


def test_resume_actions(spark):
    wanted = spark.createDataFrame([("new",), ("done",), ("half",), ("bad",)], "output_key string")
    known = spark.createDataFrame(
        [("done", "complete", "passed", True), ("half", "staged", "passed", True), ("bad", "complete", "failed", True)],
        "output_key string, commit_state string, status string, same_fingerprints boolean")
    plain = {r[0]: r[1] for r in runs.classify(wanted, known).collect()}
    assert plain == {"new": "pending", "done": "skip", "half": "retry", "bad": "skip"}
    assert {r[0] for r in runs.pending(wanted, known, True).collect()} == {"new", "half", "bad"}
    other = known.withColumn("same_fingerprints", F.lit(False))
    with pytest.raises(runs.ResumeError):
        runs.pending(wanted, other)


def test_adapters_are_checked():
    def predict(meshes, seeds, parameters):
        return meshes.vertices

    made = adapters.Adapter("crop", "mine", "1", predict, ("adapters.py",), (
        adapters.Parameter("a.n", "integer", 3, minimum=1, maximum=9), adapters.Parameter("a.mode", "string", "x", choices=("x", "y"))))
    adapters.register(made, replace=True)
    assert adapters.resolve("crop", "mine", set(), "fp32", {"a": {"n": 5}}) == {"a.n": 5, "a.mode": "x"}
    for parameters, message in (({"a": {"n": True}}, "integer"), ({"a": {"n": 10}}, "at most"),
                                ({"a": {"mode": "z"}}, "one of"), ({"b": 1}, "unknown parameters")):
        with pytest.raises(adapters.AdapterError, match=message):
            adapters.resolve("crop", "mine", set(), "fp32", parameters)
    with pytest.raises(adapters.AdapterError, match="already"):
        adapters.register(made)
    with pytest.raises(adapters.AdapterError, match="stage"):
        adapters.register(adapters.Adapter("other", "n", "1", predict, ("adapters.py",)))
    with pytest.raises(adapters.AdapterError, match="source file"):
        adapters.register(adapters.Adapter("crop", "n", "1", predict, ("../x.py",)))
    assert adapters.describe("crop", "mine")[0]["parameters"][0]["path"] == "parameters.a.n"


def test_command_codes(tmp_path, capsys):
    (tmp_path / "f").write_text("x")
    assert cli.main(["--json", "hash-assets", str(tmp_path / "f")]) == 0
    assert hashlib.sha256(b"x").hexdigest() in capsys.readouterr().out
    assert cli.main(["hash-assets"]) == 2
    assert cli.main(["adapter-info", "--adapter", "x"]) == 2
    with pytest.raises(SystemExit) as stop:
        cli.main(["run", "--resume", "--overwrite"])
    assert stop.value.code == 2
