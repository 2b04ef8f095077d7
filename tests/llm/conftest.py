import pytest

pytest.importorskip("millrace.llm")
