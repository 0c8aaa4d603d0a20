"""The domain: literacy targets, official results, student rows and places."""
