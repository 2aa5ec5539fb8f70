"""What of a web address the secret scan passes over."""

from __future__ import annotations

import pytest

from tillsight.llm import secrets

KEY = "q9ZxT3vLk8Wm2RbY7cHd"


@pytest.mark.parametrize("text", [
    f'{{"url":"https://a.example/x","k":"{KEY}"}}', f'{{"k":"{KEY}","url":"https://a.example/x"}}', f"['https://a.example/x','{KEY}']",
    f'<a href="https://a.example/x"data-k="{KEY}">', f"<a>https://a.example/x</a><b>{KEY}</b>", f"(https://a.example/x){KEY}", f"[https://a.example/x]{KEY}",
    f"{{https://a.example/x}}{KEY}", f"https://a.example/x,{KEY}", f"网址https://a.example/x，密钥{KEY}。", f"https://a.example/x密钥{KEY}",
    f"https://user:{KEY}@a.example/x", f"https://{KEY}@a.example/x", f"https://a.example/x?sig={KEY}", f"https://a.example?a=1&sig={KEY}", f"https://a.example/x#{KEY}",
    f"https://a.example/x?u=/y/&k={KEY}", f"https://user:pw@a.example/x?k={KEY}", f"https://a.example/x\\n{KEY}",
])
def test_what_follows_or_goes_with_an_address_is_scanned(text):
    spans = secrets.all_spans(text, secrets.Rules())
    assert [s[2] for s in spans] == ["entropy"]
    assert KEY not in secrets.redact(text, spans, "[SECRET]")


@pytest.mark.parametrize("text", [
    f"https://a.example/{KEY}", f"http://a.example:8080/x/{KEY}/y", f"https://{KEY}.example/x", f'"https://a.example/@me/x.{KEY}"', f"https://user@a.example/{KEY}",
    f"https://a.example/x, then https://b.example/{KEY}", f"网https://a.example/{KEY}==",
])
def test_host_and_path_are_passed_over(text):
    assert secrets.all_spans(text, secrets.Rules()) == []
