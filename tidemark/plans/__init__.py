"""Feeds and marts: what each published table contains, as functions of staged frames."""
