"""Digests (``license_digest.digest``) of entire licence texts, some with and without title or appendix."""

DIGESTS = {
    "Apache-2.0": (
        "74ae0a092ce6cbda959392ef5dcf4f00db886d9ae4a410fcbdfd364a9e5f9c14",
        "438fae0af49a14d3fe650d120d8cdeb30f90e21558a9c59f6f447cd9cacd447f",
        "a3fb63bb0e687950344578ab0cfeec72869d2fee63f84dfb44a99e718bdf6ab7",
        "098c212e7355f3c2ec232327a794e6cdb435d7be6f1f1d0a442a3923d006dab7",
        "6f5fe569562308532e409be008fd2bcd575ab48b758d34bf051326d4d1e1e234",
    ),
    "BSD-2-Clause": (
        "e9c9bae97b673903a7033e2c1d617e592c90aff7c8d70effcd7bef70a49b5ec1",
        "849eb87868e30b5497eb37a994ee1d99bbb105dcfcd173a275e34a02cdfa0f60",
        "7d8a0261970cc138b8ce706dbf2586d545b17a6e3c5d82d89b07378cea30aa14",
        "20f5d340abe503115de008071b5bf36a2ed79938a54ef74c5d7448d31bd742ad",
        "cf4a3d88ee8c14e5e54cc6e9233c09a34e4f995f39aaec69d7c39ec946873516",
        "adfd54121926efb5ae70db0b70b6ff516ae390817b8db159489b75114bfa17c9",
        "fbe37cc475811f5b71bff2f1038665da2bbcdca27cdc7afb58a3822d58ea3c55",
        "d248c26e151851d9ed6743df33f1a2a19a0b00bcd13d0cd84be018cfcfa67e6d",
        "a0bbc76e09c57f687d1a268dceffae2c183d35924f8855e6c652f6fc2a85781f",
        "a8829325d2ef33b036d00eae60d78a7a5fcb90a2b8ad5b3a774b492e5855f2a1",
        "9d4176563cba2a6f4dbc44956e26fe8b1988b9127fa52370b605fb5e52af7af6",
        "9eb18491bab38e6abe23d794808f83afcf8f42f5fb845f01471746951bab2d76",
        "d9ec883fc0e943c040878e50a2ade4de6526bb63b14b8e6a9d64c3630e2e757d",
        "379584bf150b2d26c02f7cd6657604dca575c093d12dea65deef2f8d0900b47b",
        "56e2837c71972dad895ff62a59058805bfb7d86bdd12f6cfd2511faa20b062b5",
        "0ca882d9c909474aef66b44618b9fac8a2b2c7a9face1fdec932e8a28d33d01c",
        "8d91e67804904ee3d3bee8c64df10468bc21a00b57d83180724be99a5d69c93c",
        "161f371e231e8e3f557c5477f7abc6bc3ec47295482a27c816659d7466c7cf14",
        "fb71cc0a8d1a438b03797a4bb9e319304fe82adc7cbd0f03e2a00f26495b96f2",
        "d79fd46f576856d335a2013d9a81c824a1f049c9ded495e3853ccce473eb3eb5",
    ),
    "BSD-3-Clause": (
        "5933e04d5d02834fca09f769404b4de64288ac2023a8b0cd122c0d4622cd742c",
        "bb0e650b426b47019c6cebdfc25290419f64cd7654987c39c57486522510ea64",
        "510766c849df54026eb20f614edb4265f743d18a95b2433223ab92aadf6aa4a1",
        "b928230288fe2d9c32a435728e745dbef2049b793656b1a651f740e78199cd74",
        "469b29fe2f2f8ce46006b9a20408f633b5872462bfc118eea0157d2d5622539d",
        "165cde6ee9e0a0688a4514e8990ea2934bd5cccaa17e49c5498c8f203254edc6",
        "a00a7d954327b62c79f2a7f992349055b885aa2ccc0093ce67fb13aefba20197",
        "6dfdeaf7b0118ac689e344d01811356b677b35d58ebde8918ee3b09b89e14ddd",
        "9d911c538cefe82a74fcd9bd14318b3d724885c7db514ec54004f3da02d14533",
        "fc5bb980f59783e4e8a7c6d3f4dba33810a74a3d3160c279aeebae93603278cc",
        "2126e2b3e0c9f4f1ec7ce28e1d5d6636fa441ea113cc65edfb8ce18e8738641d",
        "743921a5711704ffa2b5d33f335e2bf2b2624b95ea9c7670a0a18394acdf794b",
        "53e666e2fc39883cc87096b753d84acc5a621018888f023df90d9724d3d955b6",
        "6f6d03d28dead2982f5eff6a94444b85e37e0d7cf5ab11da5d1aeb6e1529e9f1",
        "fc022ac2ff7e960e9509cd45afdc37aaa1a197e69606ae704d4166c73e4d53ec",
        "6e112f2fc1f795facb64ad9e7fcdf63ab48bbe89f414d4a1e5a68997b3aa26e0",
        "c4ae2f9344ee8a1921e509f5afbcb1db68d4e557ee1475eaa6f13c55d0d42c6e",
        "a52ac9e7ea596f8d3f7d342955e693d04071f2d51381170c665f1890ddba3e81",
        "966e4ae54ca84ac8aa96613310c66dca8f95830c3eaff6e3eed6340afcbbddab",
        "5832de00d81058721887aa167ab41da0ff02a3ea768531f3bd29665808982e81",
    ),
    "BSL-1.0": (
        "b5837feeff182dbadc22e18244cd32f2234149121b20851b3eda3cb1f2e9b206",
    ),
    "CC-BY-SA-4.0": (
        "5c0a6e365504c7133e51eade70d5447d830345c2848eaa6ee7bea4c9953e9a8c",
    ),
    "CC0-1.0": (
        "0a1be2017ec8d38dbb0dfb4f86e1c257728a1669c7fe4d3aa53a1c459e1018ee",
    ),
    "GFDL-1.2": (
        "e91eb5f9d5d9856213578f733f5ae52f5692c9fc3cc1b05d048aff37a05aaeea",
    ),
    "GFDL-1.3": (
        "5e719d42b044f5a2be4336c9e91d4860266cc46522216361f4c9ccbb621b3657",
    ),
    "GPL-1.0": (
        "869d156f07824e4287a2959e638586941efcb3774b5e407be30ff180ac13548b",
        "080d6a98f8ea0d87100c5f3d2728f973b4c28e03aba1afefc29373590addebe8",
        "4df52f82f55fe33275276afc0459cf01ebfd5161d3b0d9b7db6c601db846a26f",
    ),
    "GPL-2.0": (
        "64a86f1d3531a8b5c1d2f564c01882c63b58c93fbfb517279bfaa9a261cb1796",
        "4e2dadef3f9f8e7c93b7824dde90f0884210defd34b976458eccb39cd1039a90",
        "b6d9bbc37df0f1f9eeaf989865222e8e8149d2661426763e656d1b7b18a8d9da",
        "71bd8e9a0341247f1d4b70d3597405aac3554d62a73a23510c2a9c436eb86bf9",
    ),
    "GPL-3.0": (
        "fbf4c7854913caaf09c170805455959454d9447e36e4d6495f74d232da3fc175",
        "c7c4b76179390b71d6bff6b733cb7894ed6499d9a3a9a174f0ae8c82d1ec8363",
        "0146dac78c87756d210fd3b26508bf1a3c85bb775a7a1fd6d471f4201103d236",
        "18fcc4594159f63c663da220d6b3cecae184696f7d3e6abdc0fb90bcd82733e2",
    ),
    "ISC": (
        "002b8b68fb54f2b8f79e7382b1cc8843bad647708dc768e3fa43ad1cd42defa2",
        "3c9008069ccaf128fa98ddb04c230302bb5202d1e712fc5c8c87ae9de4930df2",
        "21bd8538d8e6b733e83550a9f0c8ea1ad1c90cccde1cf777001f5a18615f5ce1",
        "30562802608fce8c79ea21d962ce3f97f84f90cd6fd344d2b54311160696cc7d",
        "9e4e9f84da97c51e09313c719c009ef6621a7094c0e2da957b18b482ed45f745",
        "03c2634f0fc080e570aff5aecc2837206324a5fdcd4b40f31334ca042c990c20",
        "453f4cf468e3e4cf0e5b15f451b776721ad0b8b2ae228d3c722da1ef30a97303",
        "093a8287a28fbfef66ba8695a949184f156c947cc8f2190bec46eeab2864afec",
    ),
    "LGPL-2.0": (
        "4921f4e1e5e73369d202e5c7683c965b4d275ba35f23c50d389e92705d9cc84e",
        "96d858d0220957483d204c074322d6677ca24196561ef8f5acf84c1a5b78f423",
        "03ca45506c971dd01b208250c6e0bc95609f638cdcd2c2d4754eefb600c4fead",
    ),
    "LGPL-2.1": (
        "a65b75d251fb56c535ec7079440f5d167ec95725dd20f1d16677176defe487a3",
        "f7fc82128b005526c7a24338eb3559977f0bc5b2b28e768ecbece6c3ffb908c1",
        "339c532790f41cf12c6ece26e4795bfd4801040813ec5ea72943336590b67788",
    ),
    "LGPL-3.0": (
        "572947626844a56d29ace510237040204d4085696621f319533ca366aa897913",
    ),
    "MIT": (
        "18b2cd032829c103e7fcb670e6718035e10c220d43274e082fe8c6358ea1bb46",
        "f2596cfd2e9c512616b360958dd1e3a673d0bcd4789abf2484ec73bac6c0d97a",
        "6ea1ad1c31b7c433d189401ae3a886c58b3db4d9a07ee3ff7edbdda7848a902e",
        "21ba19e44987cfc4ede7c1beee582d416c7e453d8d025209855d686ca403022f",
        "0c733b4aed7d967258ff59cb401bf2526bb0f6a089d218b1f4db413d11000169",
        "c8165306e0c0d265fbfc1836d1301be63fbd350227bc680298c0f744565a6d56",
        "3fb9fc53f4f75f4e1d52de0d23b284c63b72ad943dac03492bd42cc6c905d9bd",
        "c123f579ad10c629fdb0c48fd6bb455140346f10ff44c7ac64526ecd2a7ac4e3",
        "a38c68c691160340e149ebcc458d1fcea8f198d684a707cc19d5e856a6be2211",
        "ba45dccb70a963b7df619ccfadce4dc7070813cf0c12a1fc3c1bbf6594bd198c",
    ),
    "MPL-1.1": (
        "eb8279736f175d8e43c9688a02b2c0d9c9d5abfdc2b997dbcb3e197a1565ff33",
    ),
    "MPL-2.0": (
        "1f9b7661552309dc69cee928f7d32ed3280cbc918bfeced108b8b7d3f68f5452",
    ),
    "Unlicense": (
        "a782c22f8697e5f699413daf99a70bd246f9de384f146da06c45810ba5528696",
    ),
}
