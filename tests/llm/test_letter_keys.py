"""Random keys of letters only, and identifiers beside them."""

from __future__ import annotations

import random
import string

import pytest

from quillstone.llm import secrets


@pytest.mark.parametrize(("letters", "size"), [(string.ascii_letters, 40), (string.ascii_lowercase, 32), (string.ascii_uppercase, 32)])
def test_keys_of_letters_stand_out(letters, size):
    scan, r = secrets.scanner(), random.Random(4)
    keys = ["".join(r.choices(letters, k=size)) for _ in range(300)]
    assert sum("random:4:" in scan(f"see {k} there")[5] for k in keys) >= 298


@pytest.mark.parametrize("joint", ["-", "_", ".", "/"])
def test_grouped_keys_stand_out(joint):
    scan, r = secrets.scanner(), random.Random(5)
    keys = [joint.join("".join(r.choices(string.ascii_lowercase, k=6)) for _ in range(5)) for _ in range(300)]
    assert sum("random:4:" in scan(f"see {k} there")[5] for k in keys) >= 298


def test_identifiers_do_not():
    scan = secrets.scanner()
    for known in ("customer_account_balance_total", "CustomerAccountBalanceTotal", "MAXIMUM_RETRY_COUNT_LIMIT", "path/to/some/module/file.py", "release-notes-2024-version-12"):
        assert "random" not in scan(f"see {known} there")[5], known
