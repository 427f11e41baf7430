"""Part of harrow; see the README for its contents."""
