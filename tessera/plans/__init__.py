"""The analytics mart, its dashboard and the queries registered for them."""
