from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reelstat.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session(
        "tests",
        {
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def roots(tmp_path):
    from reelstat.plans.jobs import Roots

    return Roots(*[str(tmp_path / name) for name in ("bronze", "silver", "gold", "status")])


@pytest.fixture
def land(roots):
    """Write JSON-lines pages the way a fetcher lays them out."""

    def write(dataset: str, day: str, media_id: str, rows: list[dict], page: str = "page=0001.jsonl") -> Path:
        path = Path(roots.bronze) / dataset / f"dt={day}" / f"media_id={media_id}" / page
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(json.dumps(row, ensure_ascii=False) for row in rows), encoding="utf-8")
        return path

    return write


def values(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
