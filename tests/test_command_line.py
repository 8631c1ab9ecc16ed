from wardline.__main__ import main
from wardline.registry import TABLES


def test_commands(spark, tmp_path, capsys):
    data, out = tmp_path / "in", tmp_path / "out"
    data.mkdir()
    for name, spec in TABLES.items():
        columns = list(dict.fromkeys([*spec.required, *spec.keys, *[c for c in (spec.start, spec.end, spec.concept) if c]]))
        rows = [",".join("600000071000001" if c == "person_id" else "2024-01-01 00:00:00" if "datetime" in c else "2024-01-01" if "date" in c else "32037" if "concept" in c else str(k) for c in columns) for k in (1, 2)]
        (data / f"{name}.csv").write_text("\n".join([",".join(columns), *rows[: 1 if spec.id == "person_id" else 2]]) + "\n")
    where = ["--input", f"file://{data}"]
    assert main(["validate", *where], spark) == 0
    assert "passed" in capsys.readouterr().out
    assert main(["run", *where, "--output", f"file://{out}", "--dry-run", "--skip-modules", "mapping"], spark) == 0
    assert "mapping: skipped" in capsys.readouterr().out and not out.exists()
    assert main(["run", *where, "--output", f"file://{out}", "--min-concept-freq", "0", "--by-person"], spark) == 0
    assert "extraction: done" in capsys.readouterr().out
    assert (out / "tables" / "MEASUREMENT").exists() and (out / "rejected" / "cleaning" / "MEASUREMENT").exists() and (out / "persons" / "OBSERVATION" / "prefix=600000071").exists()
    assert main(["sample", *where, "--output", f"file://{out}/sample", "--sample-size", "5", "--resume"], spark) == 0
    assert (out / "sample" / "PERSON").exists()
    (data / "DEATH.csv").unlink()
    assert main(["validate", *where], spark) == 1
