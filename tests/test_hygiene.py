"""Repository rules that are cheap to check mechanically."""

import os
import re

ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "aspectflow")


def _sources():
    for root, _, files in os.walk(ROOT):
        for f in files:
            if f.endswith(".py"):
                path = os.path.join(root, f)
                yield path, open(path, encoding="utf-8").read()


def test_no_local_checkpoint_or_row_udf():
    for path, src in _sources():
        assert "localCheckpoint" not in src, path
        assert not re.search(r"@F\.udf|F\.udf\(|@udf\b", src), path   # row-at-a-time UDFs


def test_no_machine_local_temp_folders_in_library():
    for path, src in _sources():
        assert "tempfile" not in src and "/tmp" not in src, path
