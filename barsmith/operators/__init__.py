"""Bar operators: resampling, recursive indicators, levels, moving means, serving."""
