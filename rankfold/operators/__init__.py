"""The stages and the distributed work behind them."""
