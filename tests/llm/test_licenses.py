"""Long licences by digest, where the machine has their texts."""

import re
from pathlib import Path

import pytest

from tessera.llm import license_scan

SHIPPED = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
FOLDER = Path("/usr/share/common-licenses")


@pytest.mark.skipif(not all((FOLDER / f).exists() for f in SHIPPED.values()), reason="no licence texts here")
def test_whole_long_licences(spark):
    texts = {i: (FOLDER / f).read_text(errors="replace") for i, f in SHIPPED.items()}
    spelt = {i: "Copyright 2024 Somebody\n" + re.sub(r"\bLICENSE\b", "LICENCE", t.upper()).replace(",", " ;") + "\n\n" for i, t in texts.items()}
    rows = [*texts.items(), *spelt.items(), ("none", texts["GPL-3.0"][:-200]), ("none", texts["MPL-2.0"] + " and more"), ("none", None)]
    df = spark.createDataFrame([(n, i, t) for n, (i, t) in enumerate(rows)], "doc_id long, want string, text string")
    got = {r.doc_id: r.license_id or "none" for r in license_scan.scan(df, license_scan.catalogue(spark)).collect()}
    assert got == {n: i for n, (i, _) in enumerate(rows)}
    assert license_scan.scan(df, license_scan.catalogue(spark), {}).where("license_id IS NOT NULL").count() == 0
