"""The benchmark tables seen as campaign data, and the registered queries over them."""
