"""Scalar functions, the frame codec and digests."""
