"""Canonical digests of entire licence texts and standard headers, as ``licenses.canonical_lines`` makes them."""

# Computed from the texts of /usr/share/common-licenses; BSD-2-Clause and the general BSD-3-Clause are the
# text there with the holder's name, or the third clause, taken out.
DIGESTS = {
    "0be25ae8b112b6c47bf696a745855eebba678079747ad8bbf877d928555027f1": "Apache-2.0",  # entire text
    "adf220ee02537f83220e088f4488ca0e7557d614fac1cc48967b41d13911d6e0": "Apache-2.0",  # entire text, owner filled in
    "9446b99128ec9c3946adbb681853599f3a5f01a69d6c0762a9d0ab699868d801": "Apache-2.0",  # text without appendix
    "7a46cf4a5d56898d746584f4fe57bdf571d600a8f39d21063431d88929f803c7": "Apache-2.0",  # standard header
    "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2": "BSD-3-Clause",  # numbered, without rights line, heading none
    "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa": "BSD-3-Clause",  # bulleted, without rights line, heading none
    "eabe215ff5a2cf5b1c090915b7cabdf511f70fc79fb8fde85247ebe3038a9658": "BSD-3-Clause",  # numbered, with rights line, heading none
    "007fde9b266f35183b511c8c01994581175bfdaa48438967e905c31fb50ba523": "BSD-3-Clause",  # bulleted, with rights line, heading none
    "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15": "BSD-3-Clause",  # numbered, without rights line, heading BSD 3-Clause License
    "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af": "BSD-3-Clause",  # bulleted, without rights line, heading BSD 3-Clause License
    "cf77ee3d20f4076cecdb58fc53aa7204c9f5c0651621abbc85e028f5b2ffa6b4": "BSD-3-Clause",  # numbered, with rights line, heading BSD 3-Clause License
    "1238550805feaeec7ac6f60c2a1b7b3828c3fb1e9d9d52c718c3b75c7b5ff98e": "BSD-3-Clause",  # bulleted, with rights line, heading BSD 3-Clause License
    "e651765ec94c99c2ea03cf19aceb85785d656ba08685eb0772747c296340cb54": "BSD-3-Clause",  # numbered, without rights line, heading The 3-Clause BSD License
    "52708ae7496bad323efc341f2b977f4deecc250729644235974381dbffa10b45": "BSD-3-Clause",  # bulleted, without rights line, heading The 3-Clause BSD License
    "220781d65cabba526c5f2c828bc0b2be5176762067699c3a6a1d990c34e288e7": "BSD-3-Clause",  # numbered, with rights line, heading The 3-Clause BSD License
    "418027c022345ec370b1c9271eb22b5c5f6670ba86ef8ef468346b0236ff635c": "BSD-3-Clause",  # bulleted, with rights line, heading The 3-Clause BSD License
    "73a15ef51d0f74bce7fc4d1287b8d8a639c37581de7f63863957aea115dca7da": "BSD-3-Clause",  # numbered, without rights line, heading The BSD 3-Clause License
    "326c317935b3409d9750fd4ad5326ce15c9b75d313b4baf2cb9ff54accf8d903": "BSD-3-Clause",  # bulleted, without rights line, heading The BSD 3-Clause License
    "07002ede2e559c6e97a5ba89a53d7ded83eda46c54cea64eb39745675c2aabfc": "BSD-3-Clause",  # numbered, with rights line, heading The BSD 3-Clause License
    "da336ff5d6bbb6a30ad59a0dd798c7e6e1e57d719bbb6300725786c3648c658d": "BSD-3-Clause",  # bulleted, with rights line, heading The BSD 3-Clause License
    "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30": "BSD-2-Clause",  # numbered, without rights line, heading none
    "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74": "BSD-2-Clause",  # bulleted, without rights line, heading none
    "eda2ad636e738f6a26a2fea902bb734ee48c789a5b40035b8db3659bd951e5bc": "BSD-2-Clause",  # numbered, with rights line, heading none
    "957c3854a3d72e069e7f5e48857ad9ab76135f14c70d60fa9ec6ef9a928d45dd": "BSD-2-Clause",  # bulleted, with rights line, heading none
    "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2": "BSD-2-Clause",  # numbered, without rights line, heading BSD 2-Clause License
    "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2": "BSD-2-Clause",  # bulleted, without rights line, heading BSD 2-Clause License
    "f4befedc01589c90d5effeae5f64453726c8fded8e4b6fe6c36f99d303581f1f": "BSD-2-Clause",  # numbered, with rights line, heading BSD 2-Clause License
    "a11471bc40750a21bd4508891b5626642657a09eaa0ef1ec576be7d37fe5ada8": "BSD-2-Clause",  # bulleted, with rights line, heading BSD 2-Clause License
    "2c570d136b858b0a4d090e301862eacb53fb1ae2743462bf3b89e602191665f7": "BSD-2-Clause",  # numbered, without rights line, heading The 2-Clause BSD License
    "2e9901df2d3cdd9b2ad2d0541a98d0ffe16ec6a54494b7837b493c08b3bde071": "BSD-2-Clause",  # bulleted, without rights line, heading The 2-Clause BSD License
    "a15fcc0daac5f45ce67b8232a31ffb9da0dd18505ef702a3726b8d923d9971e9": "BSD-2-Clause",  # numbered, with rights line, heading The 2-Clause BSD License
    "aef99695204288c3828a4d0acd9e62a735a6c1781beaa3aee4aeb504f1f112db": "BSD-2-Clause",  # bulleted, with rights line, heading The 2-Clause BSD License
    "f9c0de945db946a0b06e8587a80b1b35b3f3e48a0f63cb64860eb4e433d32c7b": "BSD-2-Clause",  # numbered, without rights line, heading The BSD 2-Clause License
    "e90608a663ae638023eb95a6ae359f7b6b865e6237fa832c48500c4e1af035b9": "BSD-2-Clause",  # bulleted, without rights line, heading The BSD 2-Clause License
    "218f5b650f149e23f159537f8b1ab16d0ff44722e0038a34bb90a58b3442864a": "BSD-2-Clause",  # numbered, with rights line, heading The BSD 2-Clause License
    "b9578a124b7f83b06b28da656e009d5188b5c664c402b7c018c56cfaeb24b00a": "BSD-2-Clause",  # bulleted, with rights line, heading The BSD 2-Clause License
    "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9": "BSD-3-Clause",  # Regents, with rights line
    "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651": "BSD-3-Clause",  # Regents
    "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224": "GPL-1.0",  # entire text
    "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc": "GPL-1.0",  # text without appendix
    "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821": "GPL-2.0",  # entire text
    "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34": "GPL-2.0",  # text without appendix
    "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a": "GPL-3.0",  # entire text
    "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636": "GPL-3.0",  # text without appendix
    "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908": "LGPL-2.0",  # entire text
    "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260": "LGPL-2.0",  # text without appendix
    "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891": "LGPL-2.1",  # entire text
    "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4": "LGPL-2.1",  # text without appendix
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0",  # entire text
    "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6": "MPL-1.1",  # entire text
    "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9": "MPL-2.0",  # entire text
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",  # entire text
    "b1165b3a9c3ac2638585a8adb6e0c10814b7d97627160747134355b2690ff5af": "GPL-3.0",  # standard header
    "3606e919f92e4862a5628788f284c07f5a0ca41b819f88414d7e825dca4facc4": "GPL-2.0",  # standard header
    "a94c8ba17407040ba342fd3a13d84c51aa38a3436929cec72c706b75f9b910ab": "GPL-1.0",  # standard header
    "38fd334a43235dc3cc9b4054ff7eda2187759f1748f276e846fe99c0d3225c0f": "LGPL-2.1",  # standard header
    "07c514ba3c1f2a84ac7473a9840bc8b249b08f4c593715bb61571f488e3682cd": "LGPL-2.0",  # standard header
    "acb0bece3dc447740b87a4db23e0d425157552e4a33f273241a94444c2368900": "MPL-2.0",  # standard header
}
