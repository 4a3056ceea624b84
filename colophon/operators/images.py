"""Images of a cleaned page: which asset of a manifest each one shows, each asset once, embedded as data.

What is known about an image is read from the tree first (its description, its figure number, the addresses it may have); the
asset follows from that, and what becomes of the image follows from the asset and from what the page shows already.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urljoin, urlsplit

# Attributes that hold an image's address, how its number shows in what surrounds it, a proxy that names the original.
ADDRESSES = ["src", "data-src", "data-original", "data-lg-src"]
ALT_NUMBER = re.compile(r"(?:Figure|Fig\.)\s+(\d+)\.? ?")
NUMBERS = [
    ("original", re.compile(r"\.g(\d+)(?:[&#]|$)")),
    ("cdn", re.compile(r"(?:fig|f)0*(\d+)[a-z]?\.jpe?g(?:[?&#]|$)", re.I)),
    ("data-id", re.compile(r"f0*(\d+)$", re.I)),
    ("link", re.compile(r"-fig-0*(\d+)-")),
    ("figure", re.compile(r"^figure-(\d+)$")),
    ("wrapper", re.compile(r"^fig(\d+)$", re.I)),
]
CDN = "silverchair-cdn.com"
PROXY = re.compile(r"https://www\.frontiersin\.org/api/ipx/[^/]+/(https://www\.frontiersin\.org/files/Articles/.+)")


def address(url: str) -> str:
    return url.split("#", 1)[0]


def key(url: str) -> str:
    """Scheme and host in lower case and the path: what is left of an address whose parameters vary."""
    parts = urlsplit(url)
    return f"{parts.scheme.lower()}://{parts.netloc.lower()}{parts.path}"


@dataclass(frozen=True)
class Asset:
    path: str
    content: bytes
    content_type: str = ""

    def data_url(self) -> str:
        if not self.content:
            raise ValueError(f"an image without content: {self.path}")
        return f"data:{self.content_type or 'application/octet-stream'};base64,{base64.b64encode(self.content).decode('ascii')}"


class Manifest:
    """The images a page may show: by address, by address key where only one image has it, and large figures by number."""

    def __init__(self, rows: list[dict]):
        self.by_address: dict[str, Asset] = {}
        self.large: dict[int, Asset] = {}
        keys: dict[str, list[Asset]] = {}
        originals: dict[str, tuple[tuple[int, int], Asset]] = {}
        for row in rows:
            asset = Asset(row["path"], bytes(row["content"] or b""), row.get("content_type") or "")
            if row.get("figure") is not None:
                self.large[int(row["figure"])] = asset
            elif row.get("kind", "image") == "image":
                url = address(row["url"])
                self.by_address[url] = asset
                keys.setdefault(key(url), []).append(asset)
                proxied = PROXY.fullmatch(url)
                size = ((row.get("width") or 0) * (row.get("height") or 0), row.get("bytes") or 0)
                if proxied and size > originals.get(address(proxied.group(1)), ((-1, -1), None))[0]:
                    originals[address(proxied.group(1))] = (size, asset)
        self.by_key = {k: found[0] for k, found in keys.items() if len(found) == 1}
        for url, (_, asset) in originals.items():
            self.by_address[url] = self.by_key[key(url)] = asset

    def find(self, url: str) -> Asset | None:
        url = address(url)
        return self.by_address.get(url) or self.by_key.get(key(url))


def _around(image, tag: str, cls: str = ""):
    """The nearest element around an image with that tag and class."""
    node = image.parent
    while node is not None and not (node.tag == tag and (not cls or cls in node.attrs.get("class", "").split())):
        node = node.parent
    return node


def _links(node) -> list[str]:
    return [] if node is None else [n.attrs["href"] for n in node.elements() if n.tag == "a" and n.attrs.get("href")]


def _ancestors(image) -> Iterator:
    node = image.parent
    while node is not None:
        yield node
        node = node.parent


@dataclass
class Facts:
    """What a page tells about an image."""

    alt: str
    number: int | None
    addresses: list[str]


def facts(image) -> Facts:
    figure, box, link, span, picture = _around(image, "figure"), _around(image, "div", "figure"), _around(image, "a"), _around(image, "span"), _around(image, "picture")
    own = [image.attrs.get(a, "") for a in ADDRESSES]
    sets = [image.attrs.get("srcset", "")] + ([n.attrs.get("srcset", "") for n in picture.elements() if n.tag == "source"] if picture is not None else [])
    listed = [part.split()[0] for s in sets for part in s.split(",") if part.strip()]
    around = [link.attrs.get("href", "")] if link is not None else []
    around += _links(span) + _links(figure) + _links(box)
    alt = image.attrs.get("alt", "").strip()
    shown = {
        "original": [u for u in _links(figure) + _links(box) if "size=original" in u][:1],
        "cdn": [u for u in own[:2] if CDN in u],
        "data-id": [n.attrs["data-id"] for n in _ancestors(image) if n.attrs.get("data-id")][:1],
        "link": [u for u in _links(figure)],
        "figure": [figure.attrs.get("id", "")] if figure is not None else [],
        "wrapper": [n.attrs["id"] for n in _ancestors(image) if n.attrs.get("id", "").lower().startswith("fig")][:1],
    }
    by_alt = ALT_NUMBER.match(alt)
    found = by_alt or next((m for where, pattern in NUMBERS for text in shown[where] if (m := pattern.search(text))), None)
    return Facts(alt, int(found.group(1)) if found else None, [u for u in own + listed + around if u])


@dataclass
class Shown:
    """What the page shows already, and what became of its images."""

    paths: dict = field(default_factory=dict)
    payloads: dict = field(default_factory=dict)
    alts: set = field(default_factory=set)
    large: set = field(default_factory=set)
    embedded: int = 0
    omitted: int = 0
    duplicates: int = 0

    def counts(self) -> dict[str, int]:
        return {"embedded_images": self.embedded, "embedded_large_figures": len(self.large), "unique_embedded_assets": len(self.payloads), "omitted_images": self.omitted, "duplicate_images_removed": self.duplicates}


def _replace(image, nodes: list) -> None:
    at = next(i for i, c in enumerate(image.parent.children) if c is image)
    image.parent.children[at : at + 1] = nodes


def _earlier(shown: Shown, asset: Asset, digest: str):
    """The image that shows the same asset, or the same content under another path."""
    return shown.paths.get(asset.path) or shown.payloads.get(digest)


def embed(images: list, base_url: str, manifest: Manifest, span) -> Shown:
    """Embeds the images of a page in their order; ``span`` makes the element that stands for an image that is left out.

    A large figure comes before what the addresses lead to. The second image of an asset goes, and hands on its description if
    the first one has none. Without an asset the description stays in its place, unless an image with it is shown already.
    """
    shown = Shown()
    for image in images:
        known = facts(image)
        large = manifest.large.get(known.number) if known.number is not None else None
        asset = large or next((a for u in known.addresses if (a := manifest.find(urljoin(base_url, u)))), None)
        if asset is None:
            repeated = known.alt in shown.alts
            _replace(image, [span(f"[Image omitted: {known.alt}]", image.parent)] if known.alt and not repeated else [])
            shown.duplicates += repeated
            shown.omitted += not repeated
            continue
        data = asset.data_url()
        digest = hashlib.sha256(asset.content).hexdigest()
        first = _earlier(shown, asset, digest)
        shown.paths.setdefault(asset.path, first or image)
        if first is not None:
            if known.alt and not first.attrs.get("alt", "").strip():
                first.attrs["alt"] = known.alt
            _replace(image, [])
            shown.duplicates += 1
            continue
        shown.payloads[digest] = image
        image.attrs["src"] = data
        shown.embedded += 1
        shown.alts |= {known.alt} - {""}
        shown.large |= {known.number} if large else set()
    return shown
