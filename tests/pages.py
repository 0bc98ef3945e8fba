"""Hand-made page parts."""

import json

from reelbook.schemas import SCRIPT_ID


def script(document, ident=f'id="{SCRIPT_ID}"'):
    text = document if isinstance(document, str) else json.dumps(document, ensure_ascii=False)
    return f"<html><body><script {ident}>{text}</script></body></html>"


def detail(root=None, **parts):
    return {"__DEFAULT_SCOPE__": {"webapp.user-detail": parts}, **(root or {})}


def info(user=None, stats=None, **user_fields):
    return {
        "user": {"uniqueId": "ann", "id": "1", **user_fields} if user is None else user,
        "stats": {} if stats is None else stats,
    }


def post(ident, **fields):
    return {"id": ident, **fields}


HEAD = (
    '<h2 data-e2e="user-subtitle">ann</h2><h1 data-e2e="user-title">Ann</h1>'
    '<strong data-e2e="user-stats">1</strong><strong data-e2e="user-stats">1,234</strong>'
    '<strong data-e2e="user-stats">115.2M</strong><h2 data-e2e="user-bio">hi</h2>'
    '<a data-e2e="user-link" href="https://x.example">x</a>'
    '<img data-e2e="user-avatar" src="p.jpg"><svg data-e2e="verify-badge"></svg>'
)


def tile(url="/@ann/video/1", views="99", inner="", image='<img src="c.jpg">'):
    link = "" if url is None else f'<a href="{url}">{image}</a>'
    return (
        f'<div data-e2e="user-post-item">{link}<strong data-e2e="video-views">{views}</strong>'
        f"{inner}</div>"
    )
