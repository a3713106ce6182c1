import pytest

from textmill.functions import plain as X
from textmill.sources.archive import DelayLimiter, FetchError, TokenBucket, fetch_with_retry, retry_delay


@pytest.mark.parametrize(
    "args, latest, ids",
    [
        ([], None, None), (["--crawl", "3"], 3, None), (["--crawl", "0"], 0, None), (["--crawl", "C-1"], None, ("C-1",)),
        (["--crawl", "a,b"], None, ("a", "b")), (["--crawl", "a , b"], None, ("a", "b")), (["--crawl", "a,"], None, ("a",)),
        (["--crawl", ",a"], None, ("a",)), (["--crawl", ",,,"], None, ()), (["--crawl", "1", "--crawl", "b"], None, ("b",)),
        (["--other", "x", "--crawl", "2"], 2, None),
    ],
)
def test_crawl_spec(args, latest, ids):
    assert X.parse_crawl_spec(args) == X.CrawlSpec(latest, ids)


def test_pages_and_names():
    assert X.page_bounds("0", "1000") == (1, 100, 0) and X.page_bounds(3, 10) == (3, 10, 20) and X.page_count(26, 25) == 2
    with pytest.raises(ValueError):
        X.page_bounds("x")
    assert X.least_confidence("0.5") == 0.5 and X.least_confidence("abc") is None and X.least_confidence("0") is None
    assert X.manifest_name("legal", "", "en") == "corpus-legal-en-manifest.txt"
    assert X.duration(61_000) == "1m 1s" and X.duration(59_999) == "59s"
    assert X.progress_bar(1, 2, 4) == "━━░░" and X.progress_bar(0, 0, 3) == "░░░"


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.now += s


def bucket(rps, least, most, **more):
    clock = Clock()
    return TokenBucket(rps, least, most, clock=clock, sleep=clock.sleep, **more), clock


def test_bucket_waits():
    b, clock = bucket(2, 1, 5)
    for _ in range(2):
        b.acquire()
    assert clock.now == 0
    b.acquire()
    assert 0.4 <= clock.now <= 0.7
    b, clock = bucket(1000, 1, 1000)
    for _ in range(100):
        b.acquire()
    assert clock.now < 0.2


def test_bucket_adapts():
    b, _ = bucket(100, 10, 200, backoff=0.5)
    b.error(503)
    assert b.rps == 50
    b.error(503)
    assert b.rps == 25
    for _ in range(5):
        b.error(429)
    assert b.rps == 10
    b.error(500)
    assert b.rps == 10
    b, _ = bucket(50, 10, 200, recovery=2, streak_length=5)
    for _ in range(4):
        b.success()
    b.error(500)
    for _ in range(4):
        b.success()
    assert b.rps == 50
    b.success()
    assert b.rps == 100


def test_delay_limiter():
    d = DelayLimiter()
    for _ in range(20):
        d.success()
    assert d.delay_ms == 45
    d.back_off()
    assert d.delay_ms == 90


def test_retries():
    waits = []

    def run(*outcomes, tries=3):
        todo = list(outcomes)

        def fetch(*_):
            x = todo.pop(0)
            if isinstance(x, Exception):
                raise x
            return x

        return fetch_with_retry(fetch, "f", 0, 1, tries=tries, sleep=waits.append, jitter=lambda: 0.0)

    assert run(FetchError(503), FetchError(None), b"x") == b"x" and waits == [1, 2]
    for status in (403, 404):
        with pytest.raises(FetchError):
            run(FetchError(status), b"x")
    with pytest.raises(FetchError):
        run(FetchError(429), FetchError(429), FetchError(429))
    assert retry_delay(10, 60, lambda: 1.0) == 78
