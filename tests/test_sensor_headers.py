"""Headers of many sensor files are compared by their names, all of them."""

import pytest

from gridlloyd.sources import text


def test_other_names_behind_many_headers(spark, tmp_path):
    line = " ".join(["1"] * 19)
    for i in range(300):
        (tmp_path / f"{i}.txt").write_text(f"Time, Methane , Ethylene x, batch {i}\n{line}\n")
    assert text.read_sensor_text(spark, str(tmp_path)).columns[:3] == ["Time", "Methane", "Ethylene_x"]
    (tmp_path / "odd.txt").write_text(f"Time, CO, Ethylene x, batch\n{line}\n")
    with pytest.raises(ValueError, match="different headers"):
        text.read_sensor_text(spark, str(tmp_path))


def test_every_file_under_its_own_header(spark, tmp_path):
    rows = {}
    for i in range(6):
        names = ("Time", "Methane", "Ethylene_x") if i % 3 else ("Time_(s)", "CO")
        values = [float(100 * i + j) for j in range(len(names) + 16)]
        header = ", ".join(n.replace("_", " ") for n in names) + (", sensor readings" if len(names) == 3 else "")
        (tmp_path / f"{i}.txt").write_text(f"{header}\n{'  '.join(map(str, values))}\n")
        rows.setdefault(names, []).append(tuple(values))
    found = text.read_sensor_tables(spark, str(tmp_path))
    assert set(found) == set(rows)
    for names, df in found.items():
        assert df.columns == [*names, *[f"attr{j}" for j in range(16)]]
        assert sorted(map(tuple, df.collect())) == sorted(rows[names])
