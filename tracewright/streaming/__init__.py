"""Jobs that go on as logs arrive."""
