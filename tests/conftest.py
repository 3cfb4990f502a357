import signal
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


#: seconds that one test may take; a plan that explodes is seen as a failure and not as a hang
SECONDS_PER_TEST = 300


@pytest.fixture(autouse=True)
def time_limit(request):
    def over(*_):
        raise TimeoutError(f"{request.node.nodeid} took more than {SECONDS_PER_TEST} s")

    before = signal.signal(signal.SIGALRM, over)
    signal.alarm(SECONDS_PER_TEST)
    yield
    signal.alarm(0)
    signal.signal(signal.SIGALRM, before)


@pytest.fixture(scope="session")
def spark():
    from courtside.session import local_session

    session = local_session(8, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
