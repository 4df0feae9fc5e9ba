"""The README's example runs as it stands."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest

from tallyworks import schemas
from tallyworks.session import scratch_path
from tallyworks.sinks.tables import write_csv
from test_refresh import dimensions, sales, year_of_sales  # noqa: F401

README = Path(__file__).parent.parent / "README.md"


def test_use(spark, dimensions, tmp_path, monkeypatch):  # noqa: F811
    rows = sales(spark, year_of_sales(random.Random(6)))
    for name, frame in zip(("transactions", "customers", "products"), (rows, *dimensions), strict=True):
        write_csv(frame, f"{tmp_path}/in", f"{name}.csv")
    [code] = re.findall(r"```python\n(.*?)```", README.read_text(), re.DOTALL)
    code = code.replace('"in/', f'"{tmp_path}/in/').replace('"out"', f'"{tmp_path}/out"')
    monkeypatch.setattr("tallyworks.session.get_session", lambda **_: spark)
    names: dict = {}
    exec(compile(code, str(README), "exec"), names)
    assert names["stored"]["transactions"].count() == 900
    assert spark.sql("SELECT count(*) c FROM vw_monthly_kpis").first().c == 12
    assert Path(tmp_path, "out/csv/forecast_detail").exists()
    assert schemas.LEDGER_COLUMNS == names["stored"]["transactions"].columns


def test_scratch_copies_need_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "copy")
