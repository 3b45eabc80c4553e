from meshwright.streaming.incremental import process_arrivals
from shapes import TETRAHEDRON, obj_text


def test_only_new_files_are_processed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    seen = []

    def handle(files, batch):
        seen.append(sorted(r["path"].rsplit("/", 1)[1] for r in files.collect()))

    for name in ("a", "b"):
        (folder / f"{name}.obj").write_text(obj_text(*TETRAHEDRON))
    process_arrivals(spark, str(folder), str(tmp_path / "state"), handle)
    (folder / "c.OBJ").write_text(obj_text(*TETRAHEDRON))
    process_arrivals(spark, str(folder), str(tmp_path / "state"), handle)
    assert [names for names in seen if names] == [["a.obj", "b.obj"], ["c.OBJ"]]
