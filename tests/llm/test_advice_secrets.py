"""Secrets in the forms of env, ini and JSON files."""

from __future__ import annotations

import pytest

from folio.llm import op08_secrets

KEY = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKE1"
ACCESS = "AKIA" + "Q" * 16


def parts(text):
    return [(k, text[s:e]) for s, e, k in op08_secrets.find_secrets(text)[1]]


@pytest.mark.parametrize("form", ["AWS_ACCESS_KEY_ID={}\nAWS_SECRET_ACCESS_KEY={}", "aws_access_key_id = {}\naws_secret_access_key = {}", '{{"aws_access_key_id": "{}", "aws_secret_access_key": "{}"}}', "export ID={};export KEY='{}'"])
@pytest.mark.parametrize("key", [KEY, KEY + "=", KEY + "==", KEY[:39] + "=", KEY[:38] + "=="])
def test_key_beside_its_id(form, key):
    text = form.format(ACCESS, key)
    assert parts(text) == [("secret_part", key)]
    base, added = op08_secrets.find_secrets(text)
    assert key not in op08_secrets.redacted(text, base + added)


@pytest.mark.parametrize("run", [KEY + "x", "x" + KEY, KEY + "_", "-" + KEY, KEY + "===", KEY + "=x"])
def test_longer_runs_are_no_keys(run):
    assert parts(f"{ACCESS} K={run} ") == []


@pytest.mark.parametrize("name", ["DB_USER=admin", "MYSQL_USER: root", '"db_username": "bob', "app.login=carol", "user=dave"])
def test_prefixed_user_names(name):
    found = parts(f"{name}\nDB_PASSWORD=hunter22x")
    assert [k for k, _ in found] == ["user_part"] and found[0][1][-3:] == name[-3:]
    assert parts("superuser=admin password=hunter22x") == []
