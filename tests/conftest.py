import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from glyphmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoint"))
    session = build_session("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def texts():
    """Texts that are hard on tokenizers: white space, Unicode, long runs, special tokens."""
    return [
        "",
        "s",
        "Hello, how are you?  I'll  be there\n\n\nsoon \t now ",
        "🙃 Héllò hôw are ü? 🙃🙃",
        "a  b c　　 d",
        "x = [1, 23, 456];\r\n\tif (x) { return 'it''s'; }",
        "the the the they're we've you'd I'm it's he'll",
        "aaaa aaaaa aaaaaa " * 5,
        "Grüße aus Köln; señor, l'été déjà vu — “quoted” … ٣٤٥ 中文字符",
        "word " * 3000,
        "   ",
        "\n\n",
    ]
