"""No operator of this engine is a stream: episodes and cohorts are defined over whole tables. Every operator that is a
pure projection or filter (functions.scalars, operators.split, reject_invalid, reject_temporal) takes a streaming
DataFrame as it is."""
