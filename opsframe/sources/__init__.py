"""Reading and writing: typed CSV tables, files, manifests, lanes, views."""
