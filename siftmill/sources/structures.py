"""Download of structure files."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from pathlib import Path

#: Endings in the order they are tried, tries of each, seconds between tries.
ENDINGS, TRIES, WAIT_S = (".cif", ".pdb"), 3, 2.0


def _get(url: str) -> bytes:
    with urllib.request.urlopen(url, timeout=60) as answer:  # noqa: S310
        return answer.read()


def download(ids: Iterable[str], folder: str | Path, base_url: str, get: Callable[[str], bytes] = _get, sleep: Callable[[float], None] = time.sleep) -> dict[str, Path]:
    """Structure files by id, in capitals; those that are there already stay. All that fail are reported together."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    found, failed = {}, []
    for name in dict.fromkeys(i.strip().upper() for i in ids if i.strip()):
        there = next((folder / f"{name}{e}" for e in ENDINGS if (folder / f"{name}{e}").is_file()), None)
        if there is None:
            there = _fetched(name, folder, base_url, get, sleep)
        if there is None:
            failed.append(name)
        else:
            found[name] = there
    if failed:
        raise RuntimeError(f"structures could not be downloaded: {', '.join(failed)}")
    return found


def _fetched(name: str, folder: Path, base_url: str, get: Callable[[str], bytes], sleep: Callable[[float], None]) -> Path | None:
    for ending in ENDINGS:
        for attempt in range(TRIES):
            try:
                content = get(f"{base_url.rstrip('/')}/{name}{ending}")
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    break
            except OSError:
                pass
            else:
                path = folder / f"{name}{ending}"
                path.write_bytes(content)
                return path
            if attempt + 1 < TRIES:
                sleep(WAIT_S)
    return None
