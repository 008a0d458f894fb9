"""Filling centres and boxes of a city config from a geocoder, with a cache. Config files are small, so this runs on the driver."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

#: What a geocoder gives for a query: {"bbox": [south, west, north, east], "center": {"lat": ..., "lon": ...}}, or None.
Finder = Callable[[str], dict | None]


def queries(city: dict) -> list[str]:
    """Queries in the order in which they are tried: all names with the country, all names alone, the first with the continent."""
    name = city.get("name") or city.get("slug") or ""
    names = [n for n in [name, *city.get("aliases", [])] if n]
    with_country = [f"{n}, {city['country']}" for n in names] if city.get("country") else []
    return with_country + names + ([f"{name}, Europe"] if name else [])


def has_centre(city: dict) -> bool:
    centre = city.get("center")
    return isinstance(centre, dict) and {"lat", "lon"} <= centre.keys()


def has_box(city: dict) -> bool:
    box = city.get("bbox")
    return len(box) == 4 if isinstance(box, (list, tuple)) else isinstance(box, dict) and {"min_lat", "min_lon", "max_lat", "max_lon"} <= box.keys()


def fill(config: dict, find: Finder, cache: dict[str, dict], overwrite: bool = False) -> int:
    """Give cities that lack them a centre and a box, in place; the number of cities changed. ``cache`` is read and added to, by lower-case name."""
    changed = 0
    for city in config.get("cities", []):
        wanted = [part for part, there in (("center", has_centre(city)), ("bbox", has_box(city))) if overwrite or not there]
        if not wanted:
            continue
        key = (city.get("name") or city.get("slug") or "").lower()
        if key not in cache:
            hit = next((h for h in map(find, queries(city)) if h), None)
            if hit is None:
                continue
            cache[key] = hit
        city.update({part: cache[key][part] for part in wanted})
        changed += 1
    return changed


def from_answer(answer: list[dict]) -> dict | None:
    """What the first entry of a geocoder's JSON answer says; its box is [south, north, west, east]."""
    box = answer[0].get("boundingbox") if answer else None
    if not box or len(box) != 4:
        return None
    south, north, west, east = map(float, box)
    return {"bbox": [south, west, north, east], "center": {"lat": float(answer[0]["lat"]), "lon": float(answer[0]["lon"])}}


def web_finder(url: str, agent: str, pause: float = 1.0) -> Finder:
    """A finder that asks a web service, one request a second; what fails counts as not found."""

    def find(query: str) -> dict | None:
        time.sleep(pause)
        asked = urllib.request.Request(f"{url}?{urllib.parse.urlencode({'q': query, 'format': 'json', 'limit': 1})}", headers={"User-Agent": agent})
        try:
            with urllib.request.urlopen(asked, timeout=20) as reply:
                return from_answer(json.load(reply))
        except (urllib.error.URLError, ValueError, KeyError):
            return None

    return find
