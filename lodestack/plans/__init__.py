"""The named queries; importing this package registers them all."""

from . import corpus, finance, flows, pages, rules, signals, stores, wiki  # noqa: F401
