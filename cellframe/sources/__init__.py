"""Readers and writers: manifests, raw sample folders, datasets, marker lists and networks."""
