"""DataFrame-level operators. All take ``as_of`` where a date matters."""
