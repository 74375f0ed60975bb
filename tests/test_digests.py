"""Digests of files of any size."""

import hashlib

import pytest

from kerbside.sources import digests


@pytest.fixture
def folder(tmp_path):
    """Files around the limit of 1,000 bytes and around whole numbers of 100-byte blocks, one with a blank in its name."""
    sizes = {"none.bin": 0, "one.bin": 1, "limit.bin": 1_000, "above.bin": 1_001, "blocks.bin": 1_500, "a b%20.bin": 1_499, "other.txt": 5_000}
    for name, size in sizes.items():
        (tmp_path / "deep").mkdir(exist_ok=True)
        (tmp_path / "deep" / name).write_bytes(bytes(range(251)) * (size // 251) + b"x" * (size % 251))
    return tmp_path


def test_blocks_give_the_digest_of_the_file(spark, folder):
    found = digests.file_digests(spark, str(folder), "*.bin", whole_bytes=1_000, block_bytes=100).collect()
    want = {p.stat().st_size: hashlib.sha256(p.read_bytes()).hexdigest() for p in (folder / "deep").glob("*.bin") if p.name != "none.bin"}
    assert {r.bytes: r.sha256 for r in found} == want and len(found) == len(want)
    assert all(r.recorded_at is not None for r in found)


def test_both_ways_agree_on_columns_and_rows(spark, folder):
    whole = digests.file_digests(spark, str(folder), "*.bin")
    blocks = digests.file_digests(spark, str(folder), "*.bin", whole_bytes=-1, block_bytes=7)
    assert whole.schema == blocks.schema and whole.exceptAll(blocks).isEmpty() and blocks.exceptAll(whole).isEmpty()


def test_content_of_large_files_is_not_read(spark, folder, capsys):
    digests.file_digests(spark, str(folder), "*.bin", whole_bytes=1_000).explain("formatted")
    scans = [line for line in capsys.readouterr().out.splitlines() if line.startswith(("ReadSchema", "PushedFilters"))]
    filters, columns = scans[::2], scans[1::2]
    assert len(columns) == 2 and sum("content" in line for line in columns) == 1
    whole = next(pushed for pushed, read in zip(filters, columns) if "content" in read)
    assert "LessThanOrEqual(length,1000)" in whole


def test_file_above_two_gigabytes(spark, tmp_path):
    """A file with holes, larger than any value that the file source can hold."""
    size = (1 << 31) + 5
    with open(tmp_path / "large.bin", "wb") as file:
        file.truncate(size)
    row = digests.file_digests(spark, str(tmp_path), "*.bin").first()
    sha = hashlib.sha256()
    for _ in range(1 << 7):
        sha.update(bytes(1 << 24))
    sha.update(bytes(5))
    assert (row.bytes, row.sha256) == (size, sha.hexdigest())
