"""Streaming: nothing to build.

The reference reads one batch Parquet file and has no stream source, watermark,
time window, session or state operator. The row-wise stages of ``peakflow``
(cleaning, parsing, time parts, format rules) are plain projections and filters,
so they apply unchanged to a ``readStream`` frame; the peak label needs an exact
percentile over all windows and is a batch operation.
"""
